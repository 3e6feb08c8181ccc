"""Registered queries: one per operator of the survey's inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the driver's tables
(or relations Spark derives from them).  Doubles are rounded to 6 digits and
every computed column is aliased, so results compare with ``curato.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.functions.contract import Contract, Rule
from curato.operators import chunking, metrics, outputs, reconcile, scoring, shape, validate
from curato.operators.ranking import best_tag, dedupe_images
from curato.plans.incremental import PickState, scored_delta
from curato.plans.job import load_feed, split_feeds, validation_gate
from curato.plans.selection import select_and_reconcile
from curato.policy import Policy
from curato.session import scratch_path
from curato.sources import contracts, sinks
from curato.sources.edge_lines import (ARRAY_LINES, ARRAY_SCHEMA, COMBINED_LINES, COMBINED_SCHEMA, EDGE_SCHEMA,
                                       TREE_LINES, TREE_SCHEMA, edge_lines, template_lines)
from curato.sources.feeds import IMAGES_SCHEMA, infer_scan, number_lines, read_chunk_dir, read_typed
from curato.sources.tables import (images_view, nested_picks_view, nested_tags_view, picks_view,
                                   repeated_images_view, table, tags_view, text_images_view)

# Fixed values of the checks: the day scores are measured from, and the
# rounding applied to doubles before comparing engines.
AS_OF = dt.date(2006, 1, 1)
DIGITS = 6
POLICY_A = Policy(as_of=AS_OF, score_digits=DIGITS)
POLICY_B = Policy(variant="B", as_of=AS_OF, score_digits=DIGITS)

# The contract the event records are checked against.
EVENT_CONTRACT = Contract(rules=(
    Rule("event_id", type="integer", required=True),
    Rule("user_id", type="integer", required=True),
    Rule("event_type", type="string", required=True, enum=("click", "view", "purchase", "signup")),
    Rule("value", type="number", required=True, minimum=0, maximum=400),
    Rule("props", type="object", required=True, additional=False, properties=(
        Rule("k", type="integer", required=True, minimum=0, maximum=89),
    )),
), additional=False, name="event")


def _r(col: str) -> F.Column:
    return F.round(F.col(col), DIGITS).alias(col)


def _inputs(spark: SparkSession, sf: str):
    images = images_view(spark, sf)
    return images, tags_view(spark, sf), picks_view(spark, sf, images)


def _selection(spark: SparkSession, sf: str, policy: Policy = POLICY_A, materialize: bool | str = "scored"):
    """The reconciled relations.  The scored images are staged: two branches of
    every output read them, and without it each branch would rescan and
    reshuffle both inputs (exchange reuse does not apply once column pruning
    makes the branches differ).  Outputs that read the pick status in several
    branches (change feed, metrics) stage it and the best picks as well."""
    images, tags, picks = _inputs(spark, sf)
    return select_and_reconcile(images, tags, picks, policy, materialize=materialize), images, tags, picks


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.scored_candidates(images_view(spark, sf), tags_view(spark, sf), POLICY_A)


# -- W13-W21: best tag, lifecycle, candidates, scoring, ranking ---------------

def q_best_tag(spark, sf):
    return best_tag(tags_view(spark, sf))


def q_lifecycle_counts(spark, sf):
    return (reconcile.with_lifecycle(images_view(spark, sf))
            .groupBy("change_type").agg(F.count(F.lit(1)).cast("long").alias("n")))


def q_candidates(spark, sf):
    c = scoring.tagged_candidates(images_view(spark, sf), tags_view(spark, sf), POLICY_A)
    return c.select("image_id", "hotel_id", "change_type", "tag", "version", "probability")


def q_features(spark, sf):
    c = scoring.tagged_candidates(images_view(spark, sf), tags_view(spark, sf), POLICY_A)
    return scoring.with_features(c, POLICY_A).select(
        "image_id", "resolution", _r("aspect_ratio"), "freshness_days")


def q_sub_scores_a(spark, sf):
    return _scored(spark, sf).select("image_id", *[_r(c) for c in scoring.SCORE_COLUMNS])


def q_sub_scores_null_as_zero(spark, sf):
    policy = Policy(as_of=AS_OF, score_digits=DIGITS, null_as_zero=True)
    scored = scoring.scored_candidates(images_view(spark, sf), tags_view(spark, sf), policy)
    return scored.select("image_id", *[_r(c) for c in scoring.SCORE_COLUMNS], "image_score")


def q_tags_by_other_key(spark, sf):
    """Tags that come to images by another shared column than the image id."""
    tags = tags_view(spark, sf).withColumn("hotel_id", F.col("image_id") % 150).drop("image_id")
    sel = select_and_reconcile(images_view(spark, sf), tags, picks_view(spark, sf, images_view(spark, sf)), POLICY_A,
                               join_key="hotel_id")
    return sel.scored.select("image_id", "hotel_id", "tag", "version", "probability", "image_score")


def q_incremental_picks(spark, sf):
    """A state of an earlier image feed brought up to date by the records that changed:
    every 17th image, half of them new, half with a worse record than before."""
    now, tags = images_view(spark, sf), tags_view(spark, sf)
    k = F.col("image_id")
    better = {"width": F.lit(4000).cast("long"), "height": F.lit(3000).cast("long"), "is_active": F.lit(True)}
    earlier = now.filter(k % 34 != 0).withColumns({c: F.when(k % 17 == 0, v).otherwise(F.col(c)) for c, v in better.items()})
    state = PickState.build(scoring.scored_candidates(earlier, tags, POLICY_A), scratch_path(spark, "pick_state"), k=2)
    delta = scored_delta(now.filter(k % 17 == 0), tags, POLICY_A)
    state, _ = state.update(delta, lambda hotels: scoring.scored_candidates(
        now.join(hotels, "hotel_id", "left_semi"), tags, POLICY_A))
    return state.top()


def q_composite_a(spark, sf):
    return _scored(spark, sf).select("image_id", "hotel_id", "image_score")


def q_rank_in_group(spark, sf):
    return scoring.rank_images(_scored(spark, sf).select("hotel_id", "image_id", "image_score"))


def q_top_in_group(spark, sf):
    return scoring.top_images(_scored(spark, sf)).select("hotel_id", "image_id", "image_score", "cdn_url")


def q_top_in_group_b(spark, sf):
    top = scoring.select_variant_b(images_view(spark, sf), tags_view(spark, sf), POLICY_B)
    return top.select("hotel_id", "image_id", "tag", "version", _r("probability"),
                      *[_r(c) for c in scoring.SCORE_COLUMNS], "image_score")


# -- W22-W28: reconciliation ---------------------------------------------------

def q_pick_status(spark, sf):
    images, _, picks = _inputs(spark, sf)
    return reconcile.pick_status(picks, dedupe_images(images)).select(
        "hotel_id", "image_id", "is_active", "change_type")


def q_old_new_scores(spark, sf):
    sel = _selection(spark, sf)[0]
    return sel.status.select("hotel_id", "image_id", "change_type", "old_image_score",
                             "new_image_id", "new_image_score")


def q_updated_picks(spark, sf):
    return _selection(spark, sf)[0].updated_picks


def q_updated_picks_legacy_url(spark, sf):
    policy = Policy(as_of=AS_OF, score_digits=DIGITS, legacy_url=True)
    return _selection(spark, sf, policy)[0].updated_picks


def q_new_groups(spark, sf):
    picks = _inputs(spark, sf)[2]
    return reconcile.new_groups(_scored(spark, sf).select("hotel_id", "image_id", "image_score"), picks)


def q_live_groups_from_images(spark, sf):
    images, _, picks = _inputs(spark, sf)
    return reconcile.groups_with_live_pick(images, picks, side="images")


def q_live_groups_from_picks(spark, sf):
    images, _, picks = _inputs(spark, sf)
    return reconcile.groups_with_live_pick(images, picks, side="picks")


def q_updated_flag(spark, sf):
    sel = _selection(spark, sf)[0]
    return sel.status.select("hotel_id", "image_id", "new_image_id", "change_type", "updated")


# -- W29-W33: metrics ------------------------------------------------------------

def q_deleted_picks(spark, sf):
    images, _, picks = _inputs(spark, sf)
    return metrics.deleted_picks(reconcile.pick_status(picks, dedupe_images(images)))


def q_images_processed(spark, sf):
    return metrics.images_processed(_scored(spark, sf))


def q_picks_by_flag(spark, sf):
    return metrics.picks_by_flag(_selection(spark, sf)[0].status)


def q_distinct_flags(spark, sf):
    return metrics.distinct_flags(images_view(spark, sf))


def q_join_counts(spark, sf):
    images, tags = images_view(spark, sf), tags_view(spark, sf)
    chunk1 = chunking.assign_chunks(images.select("image_id"), 3, [F.col("image_id").asc()]) \
        .filter(F.col("chunk_id") == 1)
    return metrics.join_counts(images.select("image_id"), tags.select("image_id"), "image_id", chunk=chunk1)


# -- W05-W07, W11-W12: shapes and enrich joins -----------------------------------

def q_flatten_tags(spark, sf):
    return shape.flatten_tags(nested_tags_view(spark, sf))


def q_flatten_picks(spark, sf):
    return shape.flatten_picks(nested_picks_view(spark, sf))


def q_enrich_left(spark, sf):
    return shape.enrich(shape.images(images_view(spark, sf)), tags_view(spark, sf), "image_id", "left",
                        stage_left=False)


def q_enrich_inner(spark, sf):
    return shape.enrich(shape.images(images_view(spark, sf)), tags_view(spark, sf), "image_id", "inner")


def q_enrich_shared_columns(spark, sf):
    """Both sides have a hotel and a url besides the key."""
    images, _, picks = _inputs(spark, sf)
    return shape.enrich(images.select("image_id", "hotel_id", "cdn_url"), picks, "image_id", "left")


def q_dedupe_images(spark, sf):
    return dedupe_images(repeated_images_view(spark, sf)).select("image_id", "hotel_id", "created_at", "cdn_url")


def q_typed_images(spark, sf):
    typed = shape.images(text_images_view(spark, sf))
    return typed.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


# -- W01-W04: record contract ----------------------------------------------------

def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as one JSON line (its props object nested inside)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    j = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    line = F.concat(F.expr("left(__j, length(__j) - 1)"), F.lit(',"props":'), F.col("props"), F.lit("}"))
    return ev.withColumn("__j", j).select("event_id", line.alias("value"))


def _checked_events(spark, sf):
    return validate.check_contract(event_lines(spark, sf), EVENT_CONTRACT)


def q_contract_valid(spark, sf):
    valid, _ = validate.split_valid(_checked_events(spark, sf))
    rec = F.col("record")
    return valid.select(
        F.try_variant_get(rec, "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get(rec, "$.user_id", "bigint").alias("user_id"),
        F.try_variant_get(rec, "$.event_type", "string").alias("event_type"),
        F.round(F.try_variant_get(rec, "$.value", "double"), DIGITS).alias("value"),
        F.try_variant_get(rec, "$.props.k", "bigint").alias("k"))


def q_contract_rejected(spark, sf):
    _, rejected = validate.split_valid(_checked_events(spark, sf))
    return rejected.select("event_id", "reasons")


def q_violation_summary(spark, sf):
    return validate.violation_summary(_checked_events(spark, sf))


def q_contract_edge_cases(spark, sf):
    """Lines that meet every rule, against a contract from a JSON-Schema document."""
    checked = validate.check_contract(edge_lines(spark, sf), Contract.from_json_schema(EDGE_SCHEMA))
    return checked.select("event_id", F.array_join("violations", ";").alias("reasons"))


def q_contract_edge_summary(spark, sf):
    return validate.violation_summary(
        validate.check_contract(edge_lines(spark, sf), Contract.from_json_schema(EDGE_SCHEMA)))


def _image_lines(spark, sf) -> DataFrame:
    """The image feed as JSON lines; some are cut short, some hold a bad value."""
    k = F.col("image_id")
    rows = images_view(spark, sf).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    fields = [k.cast("string").alias("image_id"), "hotel_id", "width",
              F.when(k % 47 == 0, F.lit(-1)).otherwise(F.col("height")).cast("long").alias("height"),
              "created_at", "is_active", "cdn_url"]
    return rows.select("image_id", F.to_json(F.struct(*fields)).alias("line")).select(
        "image_id", F.when(k % 43 == 0, F.expr("left(line, 20)"))
        .when(k % 41 == 0, F.replace("line", F.lit('"hotel_id":'), F.lit('"hotel_id":"no","x":')))
        .otherwise(F.col("line")).alias("value"))


def q_validated_load(spark, sf):
    """Lines written as text, loaded through the staged, checked feed."""
    path = scratch_path(spark, "image_lines")
    _image_lines(spark, sf).select("value").write.text(path)
    _, valid, _ = load_feed(spark, path, "images")
    return valid.select("image_id", "hotel_id", "width", "height", "is_active", "cdn_url",
                        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def q_split_sink(spark, sf):
    """Valid and rejected lines written in one pass and read back."""
    path = scratch_path(spark, "split")
    halves = sinks.write_split(_checked_events(spark, sf), path)
    back = None
    for name, folder in halves.items():
        part = spark.read.schema("value string, reasons string").json(folder)
        part = part.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                           F.lit(name == "valid").alias("valid"), "reasons")
        back = part if back is None else back.unionByName(part)
    return back


def _schema_answers(spark, sf, schema, lines):
    checked = validate.check_contract(template_lines(spark, sf, lines), Contract.from_json_schema(schema))
    return checked.select("event_id", F.array_join(F.array_sort("violations"), ";").alias("reasons"))


def q_contract_combinators(spark, sf):
    """allOf, anyOf, oneOf, not, if/then/else and references."""
    return _schema_answers(spark, sf, COMBINED_SCHEMA, COMBINED_LINES)


def q_contract_arrays(spark, sf):
    """Rules over whole arrays, over keys by pattern, and between fields."""
    return _schema_answers(spark, sf, ARRAY_SCHEMA, ARRAY_LINES)


def q_contract_recursive(spark, sf):
    """Records that contain records of their own kind, to depth 8."""
    return _schema_answers(spark, sf, TREE_SCHEMA, TREE_LINES)


FILE_ROWS = 2500
SPLIT_SIZE = "16k"      # small files have several splits


def _write_in_order(lines: DataFrame, key: str, path: str) -> None:
    """Lines as one text file per ``FILE_ROWS`` keys, in order of the key."""
    part = F.lpad(F.expr(f"cast({key} div {FILE_ROWS} as string)"), 9, "0")
    (lines.withColumn("part", part).repartition("part").sortWithinPartitions("part", key)
     .select("value", "part").write.partitionBy("part").text(path))


def _numbered_events(spark, sf) -> DataFrame:
    path = scratch_path(spark, "event_lines")
    _write_in_order(event_lines(spark, sf), "event_id", path)
    return number_lines(spark, path, split_size=SPLIT_SIZE)


def _part(file: str = "file") -> F.Column:
    return F.regexp_extract(file, r"/part=0*(\d+)/", 1).cast("int")


def q_line_numbers(spark, sf):
    """Files of several splits, read with line numbers and positions over all files."""
    return _numbered_events(spark, sf).select(
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), _part().alias("part"), "line", "position")


def q_chunks_in_file_order(spark, sf):
    chunks = chunking.chunks_by_position(_numbered_events(spark, sf), 4)
    return chunks.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), "chunk_id")


def q_violation_report(spark, sf):
    """Each violation with the file and line it is in."""
    checked = validate.check_contract(_numbered_events(spark, sf), EVENT_CONTRACT, detail=True)
    report = validate.violation_report(checked, "file", "line")
    return report.select(_part().alias("part"), "line", "path", "rule", "expected",
                         F.round(F.expr("try_cast(found as double)"), DIGITS).alias("number"),
                         F.when(F.expr("try_cast(found as double)").isNull(), F.col("found")).alias("found"))


def q_repeated_keys(spark, sf):
    """Every line states two fields twice; the last value holds."""
    path = scratch_path(spark, "repeated_lines")
    twice = F.concat(F.lit('{"hotel_id":"no","image_id":5,'), F.expr("substring(value, 2)"))
    _image_lines(spark, sf).select(twice.alias("value")).write.text(path)
    _, valid, _ = load_feed(spark, path, "images", repeated="last")
    return valid.select("image_id", "hotel_id", "width", "height")


def _loose_lines(spark, sf) -> DataFrame:
    """Orders as JSON lines without a declared schema: a price that is whole or not,
    a field of two kinds, one that is always null, and nested ones."""
    k = F.col("o_orderkey")
    price = F.when(k % 3 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".25")))
    mixed = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit('"t'), k.cast("string"), F.lit('"')))
    return table(spark, sf, "orders").select(F.concat(
        F.lit('{"id":'), k.cast("string"), F.lit(',"price":'), price, F.lit(',"mixed":'), mixed, F.lit(',"none":null,"o":{"a":'),
        k.cast("string"), F.when(k % 5 == 0, F.lit(',"b":true')).otherwise(F.lit("")), F.lit('},"l":[1,'), price, F.lit("]}")).alias("value"))


def _inferred(spark, sf):
    path = scratch_path(spark, "loose_lines")
    _loose_lines(spark, sf).write.text(path)
    return infer_scan(spark, path)


def q_inferred_scan(spark, sf):
    found = _inferred(spark, sf)
    return found.rows.select("id", "price", "mixed", "none", F.col("o.a").alias("a"), F.col("o.b").alias("b"),
                             F.element_at("l", 2).alias("second"), F.lit(found.schema.simpleString()).alias("types"))


def q_inferred_conflicts(spark, sf):
    return _inferred(spark, sf).conflicts


def q_jsonl_sink(spark, sf):
    """Picks written as JSON lines and read back with their types."""
    picks = _inputs(spark, sf)[2]
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(picks, path)
    return read_typed(spark, path, picks.schema)


def q_validation_gate(spark, sf):
    """Two feeds against their contracts."""
    paths = {n: scratch_path(spark, f"gate_{n}") for n in ("images", "events")}
    _image_lines(spark, sf).select("value").write.text(paths["images"])
    event_lines(spark, sf).select("value").write.text(paths["events"])
    return validation_gate(spark, {"images": (paths["images"], contracts.IMAGE_CONTRACT), "events": (paths["events"], EVENT_CONTRACT)})


def q_split_sides(spark, sf):
    """Both feeds split in three, in file order."""
    images, tags, out = (scratch_path(spark, n) for n in ("side_images", "side_tags", "sides"))
    k = F.col("image_id")
    rows = images_view(spark, sf)
    line = F.to_json(F.struct(k.cast("string").alias("image_id"), "width"))
    _write_in_order(rows.select("image_id", line.alias("value")), "image_id", images)
    _write_in_order(rows.filter(k % 2 == 0).select("image_id", line.alias("value")), "image_id", tags)
    folders = split_feeds(spark, images, tags, "both", 3, out, SPLIT_SIZE)
    back = None
    for side, folder in folders.items():
        one = read_chunk_dir(spark, folder, IMAGES_SCHEMA).select(
            F.lit(side).alias("side"), F.col("image_id").cast("long").alias("image_id"), "width", F.col("chunk_id").cast("int").alias("chunk_id"))
        back = one if back is None else back.unionByName(one)
    return back


# -- W09-W10: chunks --------------------------------------------------------------

def _tag_lines(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_discount")
    return li


def _tag_chunks(spark, sf, n: int) -> DataFrame:
    li = _tag_lines(spark, sf)
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return chunking.assign_chunks(li, n, order).select(
        F.col("l_orderkey").alias("image_id"),
        F.concat("l_returnflag", "l_linestatus").alias("tag"),
        F.col("l_linenumber").cast("string").alias("version"),
        F.round(F.col("l_discount") * 10, 6).alias("probability"),
        "chunk_id")


def q_assign_chunks(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return chunking.assign_chunks(orders, 7, [F.col("o_orderkey").asc()])


def q_join_chunks_union(spark, sf):
    images = images_view(spark, sf).select("image_id", "hotel_id")
    return chunking.join_chunks(images, _tag_chunks(spark, sf, 3), "image_id", mode="union")


def q_join_chunks_all(spark, sf):
    images = images_view(spark, sf).select("image_id", "hotel_id")
    return chunking.join_chunks(images, _tag_chunks(spark, sf, 2), "image_id", mode="all")


def q_join_chunks_fold(spark, sf):
    """Four chunks joined in turn; a part of one chunk's rows shares one key."""
    li = table(spark, sf, "lineitem")
    hot = (F.col("l_linenumber") % 4 == 1) & (F.col("l_orderkey") % 3 == 0)
    chunks = li.select(F.when(hot, F.lit(7).cast("long")).otherwise(F.col("l_orderkey")).alias("image_id"),
                       (F.col("l_linenumber") % 4 + 1).cast("int").alias("chunk_id"), F.col("l_partkey").alias("part"))
    return chunking.fold_chunks(images_view(spark, sf).select("image_id", "hotel_id"), chunks, "image_id")


def q_chunk_roundtrip(spark, sf):
    """Lines written in three chunks, and the chunks read back as typed records."""
    lines = images_view(spark, sf).select(
        F.col("image_id").cast("string").alias("image_id"),
        F.to_json(F.struct(F.col("image_id").cast("string").alias("image_id"), "hotel_id", "width")).alias("value"))
    path = scratch_path(spark, "chunks")
    sinks.write_line_chunks(lines, 3, [F.col("image_id").asc()], path)
    return read_chunk_dir(spark, path, IMAGES_SCHEMA).select(
        "image_id", "hotel_id", "width", F.col("chunk_id").cast("int").alias("chunk_id"))


def q_join_chunks_empty(spark, sf):
    """No chunk at all leaves the rows as they are, in both modes."""
    images = images_view(spark, sf).select("image_id", "hotel_id")
    none = _tag_chunks(spark, sf, 3).filter("chunk_id > 3")
    both = [chunking.join_chunks(images, none, "image_id", mode=m).withColumn("mode", F.lit(m)) for m in ("union", "all")]
    return both[0].unionByName(both[1])


# -- W34-W37: outputs ---------------------------------------------------------------

def q_key_value(spark, sf):
    """Write the refreshed picks as key/value JSON lines, read them back."""
    picks = _selection(spark, sf)[0].updated_picks
    path = scratch_path(spark, "key_value")
    sinks.write_key_value(picks, path)
    back = read_typed(spark, path, sinks.key_value(picks).schema)
    return shape.flatten_picks(back)


def q_snapshot(spark, sf):
    # The next state needs no current picks: the best candidate of each hotel.
    return outputs.snapshot(scoring.top_images(_scored(spark, sf)))


def q_cdc(spark, sf):
    return _selection(spark, sf, materialize=True)[0].cdc


def q_metrics(spark, sf):
    return _selection(spark, sf, materialize=True)[0].metrics


# The flagship: best image per hotel with its score (and url).
def q_best_image_per_hotel(spark, sf):
    return q_top_in_group(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "best_tag": q_best_tag,
    "lifecycle_counts": q_lifecycle_counts,
    "candidates": q_candidates,
    "features": q_features,
    "sub_scores_a": q_sub_scores_a,
    "composite_a": q_composite_a,
    "rank_in_group": q_rank_in_group,
    "top_in_group": q_top_in_group,
    "top_in_group_b": q_top_in_group_b,
    "pick_status": q_pick_status,
    "old_new_scores": q_old_new_scores,
    "updated_picks": q_updated_picks,
    "updated_picks_legacy_url": q_updated_picks_legacy_url,
    "new_groups": q_new_groups,
    "live_groups_from_images": q_live_groups_from_images,
    "live_groups_from_picks": q_live_groups_from_picks,
    "updated_flag": q_updated_flag,
    "deleted_picks": q_deleted_picks,
    "images_processed": q_images_processed,
    "picks_by_flag": q_picks_by_flag,
    "distinct_flags": q_distinct_flags,
    "join_counts": q_join_counts,
    "flatten_tags": q_flatten_tags,
    "flatten_picks": q_flatten_picks,
    "contract_valid": q_contract_valid,
    "contract_rejected": q_contract_rejected,
    "violation_summary": q_violation_summary,
    "assign_chunks": q_assign_chunks,
    "join_chunks_union": q_join_chunks_union,
    "join_chunks_all": q_join_chunks_all,
    "enrich_left": q_enrich_left,
    "enrich_inner": q_enrich_inner,
    "key_value": q_key_value,
    "snapshot": q_snapshot,
    "cdc": q_cdc,
    "metrics": q_metrics,
    "dedupe_images": q_dedupe_images,
    "typed_images": q_typed_images,
    "enrich_shared_columns": q_enrich_shared_columns,
    "contract_edge_cases": q_contract_edge_cases,
    "contract_edge_summary": q_contract_edge_summary,
    "validated_load": q_validated_load,
    "split_sink": q_split_sink,
    "chunk_roundtrip": q_chunk_roundtrip,
    "join_chunks_empty": q_join_chunks_empty,
    "join_chunks_fold": q_join_chunks_fold,
    "line_numbers": q_line_numbers,
    "chunks_in_file_order": q_chunks_in_file_order,
    "violation_report": q_violation_report,
    "contract_combinators": q_contract_combinators,
    "contract_arrays": q_contract_arrays,
    "contract_recursive": q_contract_recursive,
    "repeated_keys": q_repeated_keys,
    "inferred_scan": q_inferred_scan,
    "inferred_conflicts": q_inferred_conflicts,
    "jsonl_sink": q_jsonl_sink,
    "validation_gate": q_validation_gate,
    "split_sides": q_split_sides,
    "sub_scores_null_as_zero": q_sub_scores_null_as_zero,
    "tags_by_other_key": q_tags_by_other_key,
    "incremental_picks": q_incremental_picks,
}
