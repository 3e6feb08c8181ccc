"""URL allow/block rules by a sort-merge range join (DataFrame functions only).

A rule is a host and a path.  It fits a url when the url's host is the rule's
host or one of its subdomains, and the url's path starts with the rule's path;
of the fitting rules the longest wins.

Method.  A host is reversed label by label (``www.example.org`` becomes
``org.example.www``), so a rule with its path is one canonical key, and
"starts with the rule" is an interval of keys: [key, key + byte FF).  The
intervals of a rule set are nested or apart, never crossed.  A url is looked up
under each of its host's ancestors that has rules.  Urls and rule starts are
range-partitioned and sorted together; the sweep carries the last rule started
at or before each url and that rule's stack (itself and the rules it lies in).
Every rule still open at the url lies in that stack, because a rule that opened
earlier and is still open contains the last one started; the closed ones are
popped by comparing their interval's end.

Scale.  Only distinct (host, path) keys are swept, so a url that fills a third
of the pages is one row.  The range partitions are written to the shared
folder before the sweep, one window runs per partition, and the stack open at
a partition's start comes from one row per earlier partition.

Defined cases.  A null url, or one without ``://``, has an empty host and path
and fits no rule.  Of fitting rules of one length (of different hosts) the one whose canonical
key sorts last wins.  Of rules with the same host and path a block wins over an
allow.  Rules with a null or empty host raise when the rules are built from Python
and are ignored when they come as a table; a null path counts as empty.  An
empty rule table gives every page the default verdict.  Repeated pages give
repeated rows.  Extra columns of the pages are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import staged, table

# Fixed values of the contract: (verdict, host, path).
CONTRACT_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT_VERDICT = "allow"
BREAK = "#"  # between host and path in a key: no host holds one
HIGH = "X'FF'"  # no UTF-8 text holds this byte, so it sorts after whatever continues a key
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given in Python as (verdict, host, path) rows."""
    for verdict, host, _ in rules:
        if verdict not in ("allow", "block") or not host or any(c in host for c in "/?#"):
            raise ValueError(f"not a rule: {verdict!r} {host!r}")
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p or "").alias("path"))
            for v, h, p in rules]
    empty = "array<struct<verdict:string,host:string,path:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(empty)))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with its stack: the rules that contain it and itself.

    A rule contains another one of the same host when its key is a prefix of
    the other's, so the stack is an equi-join of each key's prefixes with the
    keys; its size is bounded by the key's length."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    one = (rules.filter(F.coalesce("host", F.lit("")) != "")
           .select(reversed_host(host).alias("rev"), path.alias("rpath"),
                   F.concat(host, path).alias("rule"), (F.col("verdict") == "block").alias("block"))
           .groupBy("rev", "rpath", "rule").agg(F.max("block").alias("block")))
    prefixes = one.select("rev", "rpath", F.explode(F.sequence(F.lit(0), F.length("rpath"))).alias("n")) \
        .select("rev", F.col("rpath").alias("inner_path"), F.expr("left(rpath, n)").alias("rpath"))
    entry = F.struct(F.length("rule").alias("size"), F.concat(F.concat("rev", F.lit(BREAK), "rpath").cast("binary"), F.expr(HIGH)).alias("end"),
                     "rule", "block")
    return (prefixes.join(one, ["rev", "rpath"]).groupBy("rev", "inner_path")
            .agg(F.sort_array(F.collect_list(entry)).alias("stack"))
            .select("rev", F.concat("rev", F.lit(BREAK), "inner_path").alias("key"), "stack"))


def _sweep(points: DataFrame, starts: DataFrame) -> DataFrame:
    """For each point the stack entries open at its key: one merge of the sorted
    points and rule starts, range partition by range partition."""
    spark = points.sparkSession
    stack_type = starts.schema["stack"].dataType
    events = (starts.select("key", F.lit(0).alias("kind"), "stack",
                            F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
              .unionByName(points.select("key", F.lit(1).alias("kind"), F.lit(None).cast(stack_type).alias("stack"),
                                         "host", "path")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(events.repartitionByRange(parts, "key", "kind", "host", "path")
                   .withColumn("part", F.spark_partition_id()), "url_events")
    # What is open where a partition starts: the last rule started before it.  One row a partition.
    last = (dealt.filter("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("ends_with")))
    all_parts = dealt.select("part").distinct().join(last, "part", "left")
    carried = all_parts.select("part", F.last("ends_with", True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    inside = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (dealt.withColumn("near", F.last("stack", True).over(inside))
             .filter("kind = 1").join(carried, "part", "left")
             .withColumn("stack", F.coalesce("near", "carry")))
    return swept.select("host", "path", "key", F.filter(
        F.coalesce("stack", F.array().cast(stack_type)), lambda r: F.col("key").cast("binary") < r["end"]).alias("open"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` (page_id, url) with host, path, the winning rule and the verdict."""
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    starts = rule_stacks(rules)
    # The ancestors of each distinct host that have rules: a.b.c has c, b.c and a.b.c.
    rev = F.split(reversed_host(F.col("host")), r"\.", -1)
    hosts = (seen.select("host").distinct().filter("host != ''").withColumn("labels", rev)
             .select("host", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"), "labels")
             .select("host", F.array_join(F.slice("labels", F.lit(1), F.col("n")), ".").alias("rev"))
             .join(starts.select("rev").distinct(), "rev", "left_semi"))
    points = (seen.select("host", "path").distinct().join(hosts, "host")
              .select("host", "path", F.concat("rev", F.lit(BREAK), "path").alias("key")))
    best = (_sweep(points, starts).filter(F.size("open") > 0)
            .select("host", "path", F.array_max("open").alias("best"))
            .groupBy("host", "path").agg(F.max("best").alias("best")))
    return seen.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default))
        .otherwise(F.when(F.col("best.block"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, CONTRACT_RULES))


ORACLE = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT u.host, u.path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY u.host, u.path ORDER BY length(rhost || rpath) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM u) u
  JOIN rules ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath))
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN fit ON fit.host = u.host AND fit.path = u.path AND fit.k = 1
"""
