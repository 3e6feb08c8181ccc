"""DuckDB SQL stating what each registered query must return.

Written independently of the Spark code, over the driver's tables (views
``orders``, ``lineitem``, ``events``).  Doubles are rounded to 6 digits and
every order states its null placement, as in the Spark queries.
"""

from __future__ import annotations

from curato.sources.edge_lines import ARRAY_LINES, COMBINED_LINES, EDGE_LINES, TREE_LINES

LIFE = ("CASE WHEN {c} = false THEN 'inactive' WHEN {c} IS NULL THEN 'deleted' "
        "ELSE 'other' END")

IMAGES = """images AS (
  SELECT o_orderkey AS image_id, o_custkey AS hotel_id,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_orderkey % 89 = 0 THEN NULL
         ELSE 1 + (o_orderkey * 7919) % 4000 END AS BIGINT) AS width,
    CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE 1 + (o_orderkey * 104729) % 3000 END AS BIGINT) AS height,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL
         WHEN o_orderkey % 79 = 0 THEN o_orderdate + INTERVAL 10 YEARS
         ELSE o_orderdate END AS created_at,
    CASE WHEN o_orderstatus = 'P' OR o_custkey % 50 = 0 THEN false
         WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 0 THEN NULL ELSE true END AS is_active,
    concat('https://cdn.example.com/', CAST(o_orderkey AS VARCHAR)) AS cdn_url
  FROM orders)"""

TAGS = """tags AS (
  SELECT l_orderkey AS image_id, concat(l_returnflag, l_linestatus) AS tag,
    CAST(l_linenumber AS VARCHAR) AS version, round(l_discount * 10, 6) AS probability
  FROM lineitem)"""

PICKS = """picks AS (
  SELECT hotel_id,
    CASE WHEN hotel_id % 11 = 0 THEN 10000000 + hotel_id ELSE image_id END AS image_id,
    concat('https://cdn.example.com/', CAST(image_id AS VARCHAR)) AS cdn_url
  FROM (SELECT image_id, hotel_id,
          row_number() OVER (PARTITION BY hotel_id ORDER BY image_id) AS rn,
          count(*) OVER (PARTITION BY hotel_id) AS n
        FROM images) r
  WHERE rn = 1 + (hotel_id % n) AND hotel_id % 13 <> 0)"""

BEST_TAG = """best_tag AS (
  SELECT image_id, tag, version, probability FROM (
    SELECT image_id, tag, version, probability,
      row_number() OVER (PARTITION BY image_id
        ORDER BY probability DESC NULLS LAST, tag ASC NULLS LAST, version ASC NULLS LAST) AS rn
    FROM tags) t WHERE rn = 1)"""

IMGS = """imgs AS (
  SELECT image_id, hotel_id, width, height, created_at, is_active, cdn_url FROM (
    SELECT *, row_number() OVER (PARTITION BY image_id
      ORDER BY created_at DESC NULLS LAST, cdn_url ASC NULLS LAST) AS rn
    FROM images) d WHERE rn = 1)"""

CAND = f"""cand AS (
  SELECT i.image_id, i.hotel_id, i.width, i.height, i.created_at, i.is_active, i.cdn_url,
    b.tag, b.version, b.probability, {LIFE.format(c='i.is_active')} AS change_type
  FROM imgs i LEFT JOIN best_tag b ON i.image_id = b.image_id
  WHERE {LIFE.format(c='i.is_active')} <> 'inactive')"""

FEAT = """feat AS (
  SELECT *, width * height AS resolution,
    CASE WHEN height = 0 THEN NULL ELSE width / height END AS aspect_ratio,
    CAST(date_diff('day', CAST(created_at AS DATE), DATE '2006-01-01') AS INTEGER) AS freshness_days
  FROM {src})"""

SUBS_A = """subs AS (
  SELECT *,
    CASE WHEN resolution <= 0 THEN 0.0::DOUBLE
         ELSE least(ln(resolution / 160000.0::DOUBLE) / ln(2073600.0::DOUBLE / 160000.0::DOUBLE), 1.0::DOUBLE)
    END AS score_resolution,
    CASE WHEN aspect_ratio IS NULL THEN 0.0::DOUBLE
         WHEN aspect_ratio >= 0.3::DOUBLE AND aspect_ratio <= 4.65::DOUBLE THEN 1.0::DOUBLE
         ELSE 0.0::DOUBLE END AS score_aspect_ratio,
    CASE WHEN freshness_days > 3650 THEN 0.0::DOUBLE
         ELSE least(1.0::DOUBLE - freshness_days / 3650, 1.0::DOUBLE) END AS score_freshness,
    CAST(probability AS DOUBLE) AS score_tag_priority
  FROM feat)"""

SCORED = """scored AS (
  SELECT *, round((6.0::DOUBLE * score_resolution + 2.0::DOUBLE * score_aspect_ratio
                   + 2.0::DOUBLE * score_freshness + 3.0::DOUBLE * score_tag_priority) / 13.0::DOUBLE, 6)
            AS image_score
  FROM {src})"""

TOP = """top AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hotel_id
      ORDER BY image_score DESC NULLS LAST, image_id ASC NULLS LAST) AS rn
    FROM scored) s WHERE rn = 1)"""

STATUS = f"""status AS (
  SELECT p.hotel_id, p.image_id, i.is_active, i.cdn_url,
    {LIFE.format(c='i.is_active')} AS change_type
  FROM picks p LEFT JOIN imgs i ON p.image_id = i.image_id)"""

FLAGGED = """flagged AS (
  SELECT s.hotel_id, s.image_id, s.is_active, s.cdn_url, s.change_type,
    sc.image_score AS old_image_score, t.image_id AS new_image_id,
    t.image_score AS new_image_score, t.cdn_url AS new_cdn_url,
    CASE WHEN s.change_type = 'deleted' THEN true
         WHEN s.change_type = 'inactive' THEN true
         WHEN s.change_type = 'other' AND s.image_id <> t.image_id THEN true
         ELSE false END AS updated
  FROM status s
  LEFT JOIN scored sc ON s.image_id = sc.image_id
  LEFT JOIN top t ON s.hotel_id = t.hotel_id)"""

FEED = """feed AS (
  SELECT CASE WHEN o.has_old IS NULL THEN 'insert'
              WHEN t.hotel_id IS NULL THEN 'delete'
              WHEN o.old_image_id IS DISTINCT FROM t.image_id THEN 'update' END AS op,
    coalesce(o.hotel_id, t.hotel_id) AS hotel_id, o.old_image_id, t.image_id AS new_image_id,
    o.old_score, t.image_score AS new_score, coalesce(o.reason, 'new') AS reason
  FROM (SELECT hotel_id, image_id AS old_image_id, old_image_score AS old_score,
               change_type AS reason, true AS has_old FROM flagged) o
  FULL OUTER JOIN top t ON o.hotel_id = t.hotel_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SCORED_CTES = (IMAGES, TAGS, BEST_TAG, IMGS, CAND, FEAT.format(src="cand"), SUBS_A,
               SCORED.format(src="subs"))
RECONCILE_CTES = SCORED_CTES + (PICKS, TOP, STATUS, FLAGGED)


def _r(c: str) -> str:
    return f"round({c}, 6) AS {c}"


SUB_SCORES = ["score_resolution", "score_aspect_ratio", "score_freshness", "score_tag_priority"]

# Scorer B, checked by brute force: every image it is given takes part, live or
# not, every tag row is a candidate (fan-out), a missing probability counts 0,
# CASE clamps keep nulls.
B_CTES = (IMAGES, TAGS, IMGS, """candb AS (
  SELECT i.image_id, i.hotel_id, i.width, i.height, i.created_at, i.cdn_url,
    t.tag, t.version, coalesce(t.probability, 0.0::DOUBLE) AS probability
  FROM imgs i LEFT JOIN tags t ON i.image_id = t.image_id)""",
          FEAT.format(src="candb"), """subs0 AS (
  SELECT *,
    CASE WHEN resolution <= 0 THEN 0.0::DOUBLE
         ELSE (ln(resolution) - ln(160000.0::DOUBLE)) / (ln(2073600.0::DOUBLE) - ln(160000.0::DOUBLE))
    END AS r0,
    CASE WHEN aspect_ratio IS NULL THEN 0.0::DOUBLE
         WHEN aspect_ratio < 0.3::DOUBLE THEN 0.0::DOUBLE
         WHEN aspect_ratio > 4.65::DOUBLE THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS score_aspect_ratio,
    1.0::DOUBLE + (-1 * freshness_days) / 3650 AS f0,
    probability AS score_tag_priority
  FROM feat)""", """subsb AS (
  SELECT *, CASE WHEN r0 > 1 THEN 1.0::DOUBLE ELSE r0 END AS score_resolution,
    CASE WHEN f0 < 0 THEN 0.0::DOUBLE WHEN f0 > 1 THEN 1.0::DOUBLE ELSE f0 END AS score_freshness
  FROM subs0)""", SCORED.format(src="subsb"))

EVENTS_CHECKED = """checked AS (
  SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    concat_ws(';',
      CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'event_type:enum' END,
      CASE WHEN value < 0 THEN 'value:minimum' END,
      CASE WHEN value > 400 THEN 'value:maximum' END,
      CASE WHEN json_extract(props, '$.k') IS NULL THEN 'props.k:required' END,
      CASE WHEN json_type(props, '$.k') NOT IN ('BIGINT', 'UBIGINT') THEN 'props.k:type' END,
      CASE WHEN CAST(json_extract(props, '$.k') AS DOUBLE) < 0 THEN 'props.k:minimum' END,
      CASE WHEN CAST(json_extract(props, '$.k') AS DOUBLE) > 89 THEN 'props.k:maximum' END,
      CASE WHEN EXISTS (SELECT 1 FROM unnest(json_keys(props)) AS u(key) WHERE key <> 'k')
           THEN 'props:additional' END
    ) AS reasons
  FROM events)"""


def _tag_chunks(n: int) -> str:
    return f"""tag_chunks AS (
  SELECT l_orderkey AS image_id, concat(l_returnflag, l_linestatus) AS tag,
    CAST(l_linenumber AS VARCHAR) AS version, round(l_discount * 10, 6) AS probability,
    CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)
         // CAST(ceil(count(*) OVER () / {n}) AS BIGINT) + 1 AS INTEGER) AS chunk_id
  FROM lineitem)"""


def _edge_expected() -> str:
    """The answers written beside the edge lines, by the id's remainder; blank lines are left out."""
    n = len(EDGE_LINES)
    cases = " ".join(f"WHEN {i} THEN '{a}'" for i, (_, a) in enumerate(EDGE_LINES) if a is not None)
    blank = ", ".join(str(i) for i, (_, a) in enumerate(EDGE_LINES) if a is None)
    return f"""edge AS (
  SELECT event_id, CASE event_id % {n} {cases} END AS reasons FROM events WHERE event_id % {n} NOT IN ({blank}))"""


def _answers(lines) -> str:
    """The answers written beside template lines, their rules in order."""
    n = len(lines)
    cases = " ".join(f"WHEN {i} THEN '{';'.join(sorted(x for x in a.split(';') if x))}'"
                     for i, (_, a) in enumerate(lines) if a is not None)
    blank = ", ".join(str(i) for i, (_, a) in enumerate(lines) if a is None)
    return f"SELECT event_id, CASE event_id % {n} {cases} END AS reasons FROM events WHERE event_id % {n} NOT IN ({blank})"


# Events as lines of files of 2500 ids each, in order of the id.
PLACED = """placed AS (
  SELECT *, CAST(event_id // 2500 AS INTEGER) AS part,
    row_number() OVER (PARTITION BY event_id // 2500 ORDER BY event_id) AS line,
    row_number() OVER (ORDER BY event_id) - 1 AS position FROM checked)"""

K = "json_extract(props, '$.k')"


def _sided(source: str, side: str) -> str:
    return f"""SELECT '{side}' AS side, image_id, width, CAST((row_number() OVER (ORDER BY image_id) - 1)
        // CAST(ceil(count(*) OVER () / 3) AS BIGINT) + 1 AS INTEGER) AS chunk_id FROM {source}"""


# An unknown size or date scores 0.
ZERO_SUBS = (SUBS_A.replace("WHEN resolution <= 0", "WHEN resolution IS NULL OR resolution <= 0")
             .replace("WHEN freshness_days > 3650", "WHEN freshness_days IS NULL OR freshness_days > 3650"))

# Line items as nested tag records: null, empty, or one to three tags each.
NESTED = """nested AS (
  SELECT l_orderkey AS image_id, concat(l_returnflag, l_linestatus) AS tag, l_linenumber AS line, l_discount AS d,
    (l_linenumber + CAST(trunc(l_quantity) AS INTEGER)) % 5 AS kind FROM lineitem),
flat AS (
  SELECT image_id, unnest(CASE kind WHEN 0 THEN NULL WHEN 1 THEN [] WHEN 2 THEN [0] WHEN 3 THEN [0, 1]
                          ELSE [0, 1, 2] END) AS j, tag, line, d FROM nested)"""

REPEATED = """repeated AS (
  SELECT image_id, hotel_id, created_at, cdn_url FROM images
  UNION ALL SELECT image_id, hotel_id, created_at - INTERVAL 1 YEAR, cdn_url FROM images WHERE image_id % 3 = 0
  UNION ALL SELECT image_id, hotel_id, NULL, cdn_url FROM images WHERE image_id % 5 = 0
  UNION ALL SELECT image_id, hotel_id, created_at, cdn_url || '?again' FROM images WHERE image_id % 7 = 0)"""

STAMP = "strftime(created_at, '%Y-%m-%d %H:%M:%S')"


ORACLE: dict[str, str] = {
    "best_tag": _with(TAGS, BEST_TAG) + "SELECT image_id, tag, version, probability FROM best_tag",
    "lifecycle_counts": _with(IMAGES) + f"""SELECT {LIFE.format(c='is_active')} AS change_type,
        count(*) AS n FROM images GROUP BY 1""",
    "candidates": _with(IMAGES, TAGS, BEST_TAG, IMGS, CAND)
    + "SELECT image_id, hotel_id, change_type, tag, version, probability FROM cand",
    "features": _with(IMAGES, TAGS, BEST_TAG, IMGS, CAND, FEAT.format(src="cand"))
    + "SELECT image_id, resolution, round(aspect_ratio, 6) AS aspect_ratio, freshness_days FROM feat",
    "sub_scores_a": _with(*SCORED_CTES) + "SELECT image_id, " + ", ".join(_r(c) for c in SUB_SCORES)
    + " FROM scored",
    "composite_a": _with(*SCORED_CTES) + "SELECT image_id, hotel_id, image_score FROM scored",
    "rank_in_group": _with(*SCORED_CTES) + """SELECT hotel_id, image_id, image_score,
        row_number() OVER (PARTITION BY hotel_id
          ORDER BY image_score DESC NULLS LAST, image_id ASC NULLS LAST) AS rank FROM scored""",
    "top_in_group": _with(*SCORED_CTES, TOP) + "SELECT hotel_id, image_id, image_score, cdn_url FROM top",
    "top_in_group_b": _with(*B_CTES) + """SELECT hotel_id, image_id, tag, version,
        round(probability, 6) AS probability, """ + ", ".join(_r(c) for c in SUB_SCORES) + """, image_score
      FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id
              ORDER BY image_score DESC NULLS LAST, image_id ASC NULLS LAST,
                       probability DESC NULLS LAST, tag ASC NULLS LAST, version ASC NULLS LAST) AS rn
            FROM scored) s WHERE rn = 1""",
    "pick_status": _with(IMAGES, PICKS, IMGS, STATUS)
    + "SELECT hotel_id, image_id, is_active, change_type FROM status",
    "old_new_scores": _with(*RECONCILE_CTES) + """SELECT hotel_id, image_id, change_type,
        old_image_score, new_image_id, new_image_score FROM flagged""",
    "updated_picks": _with(*RECONCILE_CTES) + """SELECT new_image_id AS image_id,
        new_image_score AS image_score, hotel_id, new_cdn_url AS cdn_url FROM flagged""",
    "updated_picks_legacy_url": _with(*RECONCILE_CTES) + """SELECT new_image_id AS image_id,
        new_image_score AS image_score, hotel_id, cdn_url FROM flagged""",
    "new_groups": _with(*SCORED_CTES, PICKS) + """SELECT hotel_id, image_id, image_score FROM scored s
        WHERE NOT EXISTS (SELECT 1 FROM picks p WHERE p.hotel_id = s.hotel_id)""",
    "live_groups_from_images": _with(IMAGES, PICKS) + """SELECT DISTINCT i.hotel_id FROM images i
        JOIN picks p ON i.image_id = p.image_id WHERE i.is_active <> false""",
    "live_groups_from_picks": _with(IMAGES, PICKS) + """SELECT DISTINCT p.hotel_id FROM images i
        JOIN picks p ON i.image_id = p.image_id WHERE i.is_active <> false""",
    "updated_flag": _with(*RECONCILE_CTES)
    + "SELECT hotel_id, image_id, new_image_id, change_type, updated FROM flagged",
    "deleted_picks": _with(IMAGES, PICKS, IMGS, STATUS)
    + "SELECT CAST(count(*) FILTER (WHERE change_type = 'deleted') AS BIGINT) AS n FROM status",
    "images_processed": _with(*SCORED_CTES)
    + "SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT image_id FROM scored) d",
    "picks_by_flag": _with(*RECONCILE_CTES) + "SELECT updated, count(*) AS n FROM flagged GROUP BY updated",
    "distinct_flags": _with(IMAGES) + "SELECT DISTINCT is_active FROM images",
    "join_counts": _with(IMAGES, TAGS) + """SELECT 'left_rows' AS metric, (SELECT count(*) FROM images) AS value
      UNION ALL SELECT 'right_rows', (SELECT count(*) FROM tags)
      UNION ALL SELECT 'joined_rows', (SELECT count(*) FROM images i JOIN tags t ON i.image_id = t.image_id)
      UNION ALL SELECT 'chunk_joined_rows', (SELECT count(*) FROM
          (SELECT image_id, (row_number() OVER (ORDER BY image_id) - 1)
                  // CAST(ceil(count(*) OVER () / 3) AS BIGINT) + 1 AS chunk_id FROM images) c
          JOIN tags t ON c.image_id = t.image_id WHERE c.chunk_id = 1)""",
    "flatten_tags": _with(NESTED) + """SELECT image_id, tag, line || '.' || j AS version,
        CASE WHEN j < 2 THEN greatest(round(d * 10 - j / 10.0::DOUBLE, 6), 0.0::DOUBLE) END AS probability FROM flat""",
    "dedupe_images": _with(IMAGES, REPEATED) + """SELECT image_id, hotel_id, created_at, cdn_url FROM (
        SELECT *, row_number() OVER (PARTITION BY image_id
          ORDER BY created_at DESC NULLS LAST, cdn_url ASC) AS rn FROM repeated) d WHERE rn = 1""",
    "typed_images": _with(IMAGES) + f"""SELECT CAST(image_id AS VARCHAR) AS image_id, hotel_id, cdn_url,
        CASE WHEN image_id % 11 <> 0 THEN width END AS width, CASE WHEN image_id % 13 <> 0 THEN height END AS height,
        CASE WHEN image_id % 17 <> 0 AND image_id % 19 <> 0 THEN {STAMP} END AS created_at,
        CASE WHEN image_id % 23 = 0 THEN NULL WHEN image_id % 29 = 0 THEN true ELSE is_active END AS is_active
      FROM images""",
    "enrich_shared_columns": _with(IMAGES, PICKS) + """SELECT i.image_id, i.hotel_id, i.cdn_url,
        p.hotel_id AS hotel_id_right, p.cdn_url AS cdn_url_right FROM images i LEFT JOIN picks p ON i.image_id = p.image_id""",
    "contract_edge_cases": _with(_edge_expected()) + "SELECT event_id, reasons FROM edge",
    "contract_edge_summary": _with(_edge_expected()) + """SELECT rule, count(*) AS n
      FROM (SELECT unnest(string_split(reasons, ';')) AS rule FROM edge WHERE reasons <> '') r GROUP BY rule""",
    "validated_load": _with(IMAGES) + f"""SELECT CAST(image_id AS VARCHAR) AS image_id, hotel_id, width, height,
        is_active, cdn_url, {STAMP} AS created_at FROM images
      WHERE image_id % 43 <> 0 AND image_id % 41 <> 0 AND image_id % 47 <> 0""",
    "split_sink": _with(EVENTS_CHECKED) + """SELECT event_id, reasons = '' AS valid,
        CASE WHEN reasons <> '' THEN reasons END AS reasons FROM checked""",
    "chunk_roundtrip": _with(IMAGES) + """SELECT CAST(image_id AS VARCHAR) AS image_id, hotel_id, width,
        CAST((row_number() OVER (ORDER BY CAST(image_id AS VARCHAR)) - 1)
             // CAST(ceil(count(*) OVER () / 3) AS BIGINT) + 1 AS INTEGER) AS chunk_id FROM images""",
    "join_chunks_empty": _with(IMAGES) + """SELECT image_id, hotel_id, mode FROM images,
        (VALUES ('union'), ('all')) m(mode)""",
    "flatten_picks": _with(IMAGES, PICKS) + "SELECT hotel_id, image_id, cdn_url FROM picks",
    "contract_valid": _with(EVENTS_CHECKED) + """SELECT event_id, user_id, event_type,
        round(value, 6) AS value, k FROM checked WHERE reasons = ''""",
    "contract_rejected": _with(EVENTS_CHECKED) + "SELECT event_id, reasons FROM checked WHERE reasons <> ''",
    "violation_summary": _with(EVENTS_CHECKED) + """SELECT rule, count(*) AS n
      FROM (SELECT unnest(string_split(reasons, ';')) AS rule FROM checked WHERE reasons <> '') r
      GROUP BY rule""",
    "assign_chunks": """SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1)
        // CAST(ceil(count(*) OVER () / 7) AS BIGINT) + 1 AS INTEGER) AS chunk_id FROM orders""",
    "join_chunks_union": _with(IMAGES, _tag_chunks(3)) + """SELECT i.image_id, i.hotel_id, c.tag, c.version,
        c.probability, c.chunk_id FROM images i JOIN tag_chunks c ON i.image_id = c.image_id""",
    "join_chunks_all": _with(IMAGES, _tag_chunks(2)) + """SELECT image_id, hotel_id FROM images
      WHERE image_id IN (SELECT image_id FROM tag_chunks GROUP BY image_id
        HAVING count(DISTINCT chunk_id) = (SELECT count(DISTINCT chunk_id) FROM tag_chunks))""",
    "enrich_left": _with(IMAGES, TAGS) + """SELECT i.image_id, i.hotel_id, i.cdn_url, i.width, i.height,
        i.created_at, i.is_active, t.tag, t.version, t.probability
      FROM images i LEFT JOIN tags t ON i.image_id = t.image_id""",
    "enrich_inner": _with(IMAGES, TAGS) + """SELECT i.image_id, i.hotel_id, i.cdn_url, i.width, i.height,
        i.created_at, i.is_active, t.tag, t.version, t.probability
      FROM images i JOIN tags t ON i.image_id = t.image_id""",
    "key_value": _with(*RECONCILE_CTES) + """SELECT hotel_id, new_image_id AS image_id,
        new_cdn_url AS cdn_url FROM flagged""",
    "snapshot": _with(*SCORED_CTES, TOP) + "SELECT hotel_id, image_id, cdn_url, image_score FROM top",
    "cdc": _with(*RECONCILE_CTES, FEED) + """SELECT op, hotel_id, old_image_id, new_image_id,
        old_score, new_score, reason FROM feed WHERE op IS NOT NULL""",
    "metrics": _with(*RECONCILE_CTES, FEED) + """
      SELECT 'picks_deleted' AS metric, CAST(count(*) FILTER (WHERE change_type = 'deleted') AS BIGINT) AS value FROM flagged
      UNION ALL SELECT 'images_processed', (SELECT count(*) FROM (SELECT DISTINCT image_id FROM scored) d)
      UNION ALL SELECT 'picks_updated', (SELECT count(*) FILTER (WHERE updated) FROM flagged)
      UNION ALL SELECT 'picks_unchanged', (SELECT count(*) FILTER (WHERE NOT updated) FROM flagged)
      UNION ALL SELECT 'cdc_inserts', (SELECT count(*) FILTER (WHERE op = 'insert') FROM feed)
      UNION ALL SELECT 'cdc_updates', (SELECT count(*) FILTER (WHERE op = 'update') FROM feed)
      UNION ALL SELECT 'cdc_deletes', (SELECT count(*) FILTER (WHERE op = 'delete') FROM feed)
      UNION ALL SELECT 'snapshot_rows', (SELECT count(*) FROM top)""",
    "join_chunks_fold": _with(IMAGES) + """, c AS (
        SELECT CASE WHEN l_linenumber % 4 = 1 AND l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS image_id,
               l_linenumber % 4 + 1 AS chunk, l_partkey AS part FROM lineitem)
      SELECT i.image_id, i.hotel_id, a.part AS part_1, b.part AS part_2, c3.part AS part_3, d.part AS part_4
      FROM images i JOIN c a ON a.chunk = 1 AND a.image_id = i.image_id JOIN c b ON b.chunk = 2 AND b.image_id = i.image_id
      JOIN c c3 ON c3.chunk = 3 AND c3.image_id = i.image_id JOIN c d ON d.chunk = 4 AND d.image_id = i.image_id""",
    "line_numbers": _with(EVENTS_CHECKED, PLACED) + "SELECT event_id, part, line, position FROM placed",
    "chunks_in_file_order": _with(EVENTS_CHECKED, PLACED) + """SELECT event_id,
        CAST(position // CAST(ceil(count(*) OVER () / 4) AS BIGINT) + 1 AS INTEGER) AS chunk_id FROM placed""",
    "violation_report": _with(EVENTS_CHECKED, """raw AS (SELECT event_id, props FROM events)""", PLACED, f"""bad AS (
        SELECT part, line, 'event_type' AS path, 'enum' AS rule, 'one of ["click", "view", "purchase", "signup"]' AS expected,
               NULL::DOUBLE AS number, '"' || event_type || '"' AS found
        FROM placed WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')
        UNION ALL SELECT part, line, 'value', 'minimum', 'at least 0', round(value, 6), NULL FROM placed WHERE value < 0
        UNION ALL SELECT part, line, 'value', 'maximum', 'at most 400', round(value, 6), NULL FROM placed WHERE value > 400
        UNION ALL SELECT part, line, 'props.k', 'required', 'a value', NULL, NULL
        FROM placed JOIN raw USING (event_id) WHERE {K} IS NULL
        UNION ALL SELECT part, line, 'props.k', 'type', 'integer', TRY_CAST({K} AS DOUBLE), CAST({K} AS VARCHAR)
        FROM placed JOIN raw USING (event_id) WHERE json_type(props, '$.k') NOT IN ('BIGINT', 'UBIGINT')
        UNION ALL SELECT part, line, 'props.k', 'minimum', 'at least 0', CAST({K} AS DOUBLE), NULL
        FROM placed JOIN raw USING (event_id) WHERE CAST({K} AS DOUBLE) < 0
        UNION ALL SELECT part, line, 'props.k', 'maximum', 'at most 89', CAST({K} AS DOUBLE), NULL
        FROM placed JOIN raw USING (event_id) WHERE CAST({K} AS DOUBLE) > 89
        UNION ALL SELECT part, line, 'props', 'additional', 'no undeclared keys', NULL,
               array_to_string(list_sort([x FOR x IN json_keys(props) IF x <> 'k']), ', ')
        FROM placed JOIN raw USING (event_id) WHERE len([x FOR x IN json_keys(props) IF x <> 'k']) > 0)""")
      + "SELECT part, line, path, rule, expected, number, found FROM bad",
    "contract_combinators": _answers(COMBINED_LINES),
    "contract_arrays": _answers(ARRAY_LINES),
    "contract_recursive": _answers(TREE_LINES),
    "repeated_keys": _with(IMAGES) + """SELECT CAST(image_id AS VARCHAR) AS image_id, hotel_id, width, height FROM images
      WHERE image_id % 43 <> 0 AND image_id % 41 <> 0 AND image_id % 47 <> 0""",
    "inferred_scan": """SELECT o_orderkey AS id, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 0.25 END::DOUBLE AS price,
        CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 't' END || o_orderkey AS mixed, NULL::VARCHAR AS none, o_orderkey AS a,
        CASE WHEN o_orderkey % 5 = 0 THEN true END AS b,
        o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 0.25 END::DOUBLE AS second,
        'struct<id:bigint,l:array<double>,mixed:string,none:string,o:struct<a:bigint,b:boolean>,price:double>' AS types
      FROM orders""",
    "inferred_conflicts": """SELECT '$.mixed' AS path, CASE WHEN o_orderkey % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END AS kind,
        count(*) AS n FROM orders GROUP BY 2""",
    "jsonl_sink": _with(IMAGES, PICKS) + "SELECT hotel_id, image_id, cdn_url FROM picks",
    "validation_gate": _with(IMAGES, EVENTS_CHECKED) + """SELECT 'images' AS feed, 'images_valid' AS metric,
        count(*) FILTER (WHERE image_id % 43 <> 0 AND image_id % 41 <> 0 AND image_id % 47 <> 0) AS value FROM images
      UNION ALL SELECT 'images', 'images_rejected',
        count(*) FILTER (WHERE image_id % 43 = 0 OR image_id % 41 = 0 OR image_id % 47 = 0) FROM images
      UNION ALL SELECT 'events', 'events_valid', count(*) FILTER (WHERE reasons = '') FROM checked
      UNION ALL SELECT 'events', 'events_rejected', count(*) FILTER (WHERE reasons <> '') FROM checked""",
    "split_sides": _with(IMAGES) + _sided("images", "images") + " UNION ALL " + _sided(
        "(SELECT * FROM images WHERE image_id % 2 = 0) e", "tags"),
    "sub_scores_null_as_zero": _with(IMAGES, TAGS, BEST_TAG, IMGS, CAND, FEAT.format(src="cand"), ZERO_SUBS, SCORED.format(src="subs"))
    + "SELECT image_id, " + ", ".join(_r(c) for c in SUB_SCORES) + ", image_score FROM scored",
    "tags_by_other_key": _with(IMAGES, """tags AS (
        SELECT l_orderkey % 150 AS image_id, concat(l_returnflag, l_linestatus) AS tag, CAST(l_linenumber AS VARCHAR) AS version,
               round(l_discount * 10, 6) AS probability FROM lineitem)""", BEST_TAG, IMGS,
        CAND.replace("ON i.image_id = b.image_id", "ON i.hotel_id = b.image_id"), FEAT.format(src="cand"), SUBS_A,
        SCORED.format(src="subs")) + "SELECT image_id, hotel_id, tag, version, probability, image_score FROM scored",
    "incremental_picks": _with(*SCORED_CTES, TOP) + "SELECT hotel_id, image_id, image_score, cdn_url FROM top",
}
