"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

The sources form a tree: domain, language, source.  A token budget flows down:
every node shares its budget among its children in proportion to their
weights, but no child gets more than it can supply (the tokens below it, times
the epochs allowed).  What a short child leaves is shared again among its
siblings, and only what all the siblings cannot take goes back to the
ancestors' other children.  As a node's own supply already bounds what it is
given, one pass from the root to the leaves settles all of that exactly.

Each leaf then takes its budget as a prefix of seeded epochs: an epoch is the
leaf's documents in an order drawn from (seed, epoch); whole epochs are taken
while the budget lasts, and of the next one the documents up to the first that
does not fit any more.

Scale.  The tree's numbers are one aggregate.  A leaf is never sorted in one
task: its documents fall into buckets by the leading digits of their order key
(about ``BUCKET_ROWS`` documents each, whatever the leaf's size), bucket sums
decide which buckets lie inside the prefix, and only the one bucket that the
prefix ends in is sorted.

Defined cases.  Null languages and sources form leaves of their own, ``und`` and
``unknown``; a null text has no tokens and costs nothing.  Sources without a
domain belong to ``DEFAULT_DOMAIN``.  Weights missing from the table are 1; a
weight of 0 takes the node out.  All amounts are whole numbers; fewer tokens
than a node has children may stay unspent through rounding down.  Documents
with equal order keys are taken in the order of id and size.  An empty table
gives an empty result.  Extra columns are ignored by ``mix_plan`` and kept by
``mix_stage``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import WORD, numbered_rows, staged, table

DEFAULT_DOMAIN = "web"
BUCKET_ROWS = 5000
KEY_DIGITS = 7          # hex digits of the order key that make buckets

# The production mix: the domains of the sources, and the weights of the tree's nodes.
DOMAINS = {"src0": "forum", "src1": "forum", "src2": "books", "src3": "books", "src4": "news", "src5": "news"}
DOMAIN_WEIGHTS = {"web": 5, "news": 2, "books": 2, "forum": 1}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 2}


@dataclass(frozen=True)
class Mix:
    """Targets: the budget in percent of all tokens, the epochs allowed, the
    seed, and the tree (a source's domain; weights of domains, languages and
    sources; what is not named weighs 1)."""

    budget_percent: int = 60
    max_epochs: int = 2
    seed: int = 17
    domains: Mapping[str, str] = field(default_factory=lambda: DOMAINS)
    domain_weights: Mapping[str, int] = field(default_factory=lambda: DOMAIN_WEIGHTS)
    language_weights: Mapping[str, int] = field(default_factory=lambda: LANGUAGE_WEIGHTS)
    source_weights: Mapping[str, int] = field(default_factory=dict)


PRODUCTION = Mix()
PIPELINE = Mix(budget_percent=80, max_epochs=1)


def _lookup(values: Mapping[str, object], key: Column, default: object) -> Column:
    """A bounded table of settings as one CASE over the key."""
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def leaf_rows(docs: DataFrame, mix: Mix, row_id: Column | None = None) -> DataFrame:
    """Row id, doc_id, leaf (domain, lang, source) and number of words of each document."""
    source = F.coalesce("source", F.lit("unknown"))
    number = F.monotonically_increasing_id() if row_id is None else row_id
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(number.alias("row_id"), "doc_id", _lookup(mix.domains, source, DEFAULT_DOMAIN).alias("domain"),
                       F.coalesce("lang", F.lit("und")).alias("lang"), source.alias("source"),
                       tokens.alias("n_tokens"))


# -- budgets -----------------------------------------------------------------------

def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Give each child of each parent its part of the parent's ``budget``.

    Children are sorted by supply per weight; the ones first in that order that
    cannot use their proportional part are filled up, and the rest of the
    budget is shared by the others in proportion."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy((F.col("supply").cast("double") / F.col("weight")).asc(), F.col(name).asc())
    wide = "decimal(38,0)"
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    step = (children.filter("weight > 0")
            .withColumn("left", F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0)))
            .withColumn("weights", F.sum("weight").over(after))
            .withColumn("full", F.col("supply").cast(wide) * F.col("weights")
                        <= F.col("left").cast(wide) * F.col("weight")))
    filled = F.sum(F.when(F.col("full"), F.col("supply")).otherwise(F.lit(0))).over(by)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(by)
    part = F.expr("CAST((CAST(budget - filled AS decimal(38,0)) * weight) div greatest(open_weight, 1) AS bigint)")
    return (step.withColumn("filled", filled).withColumn("open_weight", open_weight)
            .withColumn("given", F.when(F.col("full"), F.col("supply")).otherwise(F.least(F.col("supply"), part)))
            .drop("left", "weights", "full", "filled", "open_weight"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, budget, n_docs, tokens) of every leaf, from its documents' counts."""
    stats = staged(leaves.groupBy("domain", "lang", "source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "leaves")
    stats = stats.withColumn("supply", F.col("tokens") * mix.max_epochs)
    # A node can use what its children of positive weight can; one without such children, nothing.
    source_weight = _lookup(mix.source_weights, F.col("source"), 1).cast("long")
    lang_weight = _lookup(mix.language_weights, F.col("lang"), 1).cast("long")
    in_lang = F.when(source_weight > 0, F.col("supply")).otherwise(F.lit(0))
    in_domain = F.when(lang_weight > 0, in_lang).otherwise(F.lit(0))
    # The root's children: as many rows as there are domains.
    domains = (stats.groupBy("domain").agg(F.sum(in_domain).alias("supply"), F.sum("tokens").alias("tokens"))
               .withColumn("weight", _lookup(mix.domain_weights, F.col("domain"), 1).cast("long"))
               .withColumn("budget", F.expr(
                   f"sum(tokens) OVER (PARTITION BY 0) * {int(mix.budget_percent)} div 100").cast("long")))
    domains = _share(domains, [], "domain").select("domain", F.col("given").alias("budget"))
    langs = (stats.groupBy("domain", "lang").agg(F.sum(in_lang).alias("supply"))
             .withColumn("weight", lang_weight)
             .join(domains, "domain"))
    langs = _share(langs, ["domain"], "lang").select("domain", "lang", F.col("given").alias("budget"))
    sources = (stats.withColumn("weight", source_weight)
               .join(langs, ["domain", "lang"]))
    return staged(_share(sources, ["domain", "lang"], "source").select(
        "domain", "lang", "source", F.col("given").alias("budget"), "n_docs", "tokens"), "budgets")


# -- selection ---------------------------------------------------------------------

def order_key(seed: int, epoch: Column) -> Column:
    """The document's place in an epoch of its leaf: 32 hex digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string")))


def mix_plan(docs: DataFrame, mix: Mix = PRODUCTION, row_id: Column | None = None) -> DataFrame:
    """One row per document: row_id, doc_id, its leaf, n_tokens and copies (how
    often the mix takes it; 0 for not at all)."""
    leaf = ["domain", "lang", "source"]
    rows = staged(leaf_rows(docs, mix, row_id), "mix_rows")
    budgets = leaf_budgets(rows, mix)
    # A leaf takes ``whole`` epochs and of the next one the first ``rest`` tokens.
    plan = budgets.select(
        *leaf, F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget div tokens END").alias("whole"),
        F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END").alias("rest"),
        F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long").alias("buckets"))
    space = 16 ** KEY_DIGITS
    number = F.conv(F.substring("key", 1, KEY_DIGITS), 16, 10).cast("long")
    dealt = (rows.join(plan, leaf, "left").na.fill({"whole": 0, "rest": -1, "buckets": 1})
             .withColumn("key", order_key(mix.seed, F.col("whole")))
             .withColumn("bucket", F.floor(number * F.col("buckets") / F.lit(space)).cast("long")))
    dealt = staged(dealt, "mix_dealt")
    sums = dealt.groupBy(*leaf, "bucket", "rest").agg(F.sum("n_tokens").alias("t"))
    running = Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (sums.withColumn("ahead", F.coalesce(F.sum("t").over(running), F.lit(0)))
            .withColumn("state", F.when(F.col("ahead") + F.col("t") <= F.col("rest"), F.lit("in"))
                        .when(F.col("ahead") > F.col("rest"), F.lit("out")).otherwise(F.lit("cut")))
            .select(*leaf, "bucket", "ahead", "state"))
    placed = dealt.join(ends, [*leaf, "bucket"])
    inside = Window.partitionBy(*leaf, "bucket").orderBy("key", "doc_id", "n_tokens", "row_id") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (placed.filter("state = 'cut'").withColumn("upto", F.col("ahead") + F.sum("n_tokens").over(inside))
           .withColumn("more", (F.col("upto") <= F.col("rest")).cast("long")).drop("upto"))
    clear = placed.filter("state <> 'cut'").withColumn("more", (F.col("state") == "in").cast("long"))
    return clear.unionByName(cut).select("row_id", "doc_id", *leaf, "n_tokens",
                                         (F.col("whole") + F.col("more")).alias("copies"))


def mix_stage(docs: DataFrame, mix: Mix = PIPELINE) -> DataFrame:
    """The documents the mix takes, once per copy, all columns as they came."""
    rows, needed = numbered_rows(docs, "mix_in", "doc_id", "text", "lang", "source")
    taken = mix_plan(needed, mix, F.col("row")).filter("copies > 0").select(
        F.col("row_id").alias("row"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.join(taken, "row").select("user.*")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents")).drop("row_id")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, CASE coalesce(source, 'unknown') WHEN 'src0' THEN 'forum' WHEN 'src1' THEN 'forum'
           WHEN 'src2' THEN 'books' WHEN 'src3' THEN 'books' WHEN 'src4' THEN 'news' WHEN 'src5' THEN 'news'
           ELSE 'web' END AS domain,
         coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::HUGEINT AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * 2 AS supply
         FROM d GROUP BY ALL),
d0 AS (
  SELECT domain AS name, sum(supply)::HUGEINT AS supply,
         (CASE domain WHEN 'web' THEN 5 WHEN 'news' THEN 2 WHEN 'books' THEN 2 ELSE 1 END)::HUGEINT AS weight,
         (SELECT sum(tokens)::HUGEINT * 60 // 100 FROM leaf) AS budget FROM leaf GROUP BY domain),
d1 AS (SELECT *, budget - coalesce(sum(supply) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
              sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
       FROM d0 WINDOW w AS (ORDER BY supply::DOUBLE / weight::DOUBLE, name)),
d2 AS (SELECT *, supply * ws <= lft * weight AS ok FROM d1),
d3 AS (SELECT name AS domain, CASE WHEN ok THEN supply ELSE least(supply,
         ((budget - sum(CASE WHEN ok THEN supply ELSE 0 END) OVER ()) * weight)::HUGEINT
         // greatest(sum(CASE WHEN ok THEN 0 ELSE weight END) OVER (), 1)::HUGEINT) END::HUGEINT AS budget FROM d2),
l0 AS (
  SELECT domain, lang AS name, sum(supply)::HUGEINT AS supply,
         (CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END)::HUGEINT AS weight
  FROM leaf GROUP BY domain, lang),
l1 AS (SELECT l0.*, budget,
              budget - coalesce(sum(supply) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
              sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
       FROM l0 JOIN d3 USING (domain)
       WINDOW w AS (PARTITION BY domain ORDER BY supply::DOUBLE / weight::DOUBLE, name)),
l2 AS (SELECT *, supply * ws <= lft * weight AS ok FROM l1),
l3 AS (SELECT domain, name AS lang, CASE WHEN ok THEN supply ELSE least(supply,
         ((budget - sum(CASE WHEN ok THEN supply ELSE 0 END) OVER (PARTITION BY domain)) * weight)::HUGEINT
         // greatest(sum(CASE WHEN ok THEN 0 ELSE weight END) OVER (PARTITION BY domain), 1)::HUGEINT) END::HUGEINT
         AS budget FROM l2),
s1 AS (SELECT leaf.*, 1::HUGEINT AS weight, budget,
              budget - coalesce(sum(supply) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
              count(*) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
       FROM leaf JOIN l3 USING (domain, lang)
       WINDOW w AS (PARTITION BY domain, lang ORDER BY supply::DOUBLE, source)),
s2 AS (SELECT *, supply * ws <= lft * weight AS ok FROM s1),
s3 AS (SELECT domain, lang, source, tokens, CASE WHEN ok THEN supply ELSE least(supply,
         (budget - sum(CASE WHEN ok THEN supply ELSE 0 END) OVER (PARTITION BY domain, lang))::HUGEINT
         // greatest(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY domain, lang), 1)::HUGEINT) END::HUGEINT
         AS budget FROM s2),
p AS (SELECT *, CASE WHEN tokens = 0 THEN 0 ELSE budget // tokens END AS whole,
             CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM s3),
r AS (SELECT d.*, whole, rest, sum(n_tokens) OVER (
        PARTITION BY d.domain, d.lang, d.source
        ORDER BY md5(concat_ws('|', '17', whole::BIGINT::VARCHAR, doc_id::VARCHAR)), doc_id, n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM r
"""
