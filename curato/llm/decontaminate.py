"""Benchmark decontamination by winnowing (DataFrame functions only).

A benchmark item's window is ten consecutive words; an item with fewer words,
but not none, is one window.  A document word inside any occurrence of a window
is hit, and an item is hit when one of its windows occurs.

Method.  Winnowing with k-grams of k = 5 words keeps, of every run of w = 6
neighbouring k-grams (k + w - 1 = 10 words), the least hash, so two texts that
share ten words in a row always share a kept hash.  Shorter windows of m words
use k = (m + 1) div 2 and w = m - k + 1 in the same way, for the lengths m that
the benchmark has.  Neighbouring document windows with one least hash form one
fingerprint: (hash, first window, last window).  Document fingerprints are
joined with the benchmark's; each hit is then extended to the words of all its
windows, and these are compared with the benchmark's windows word by word, so a
colliding hash adds nothing.  Windows that occur are merged to maximal spans.

Scale.  The documents are read once.  Their arrays of words and hashes stay in
the row that they come from; fingerprints (about 2 in 7 words) meet the
benchmark's without a shuffle while those are few (``MAX_FINGERPRINTS`` rows of
two numbers, counted before), and by a shuffle on the hash beyond, with the
same result.  Only hits and one row per document are staged.  Everything after
is grouped by a number of the document row, so copies of a text, a repeated id
or a passage that many documents share gather nowhere.

Defined cases.  A null or empty text has no words.  Windows may overlap and
repeat; each word counts once.  Items with equal texts are separate items; rows
of one item_id are one item.  An item whose id is null marks words, but has no
id to name, so it is not counted among the items.  Repeated documents give
repeated rows.  An empty benchmark leaves every document clean; empty documents
give no rows.  Extra columns of either table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import staged, table

# Fixed values of the contract: the word class (after A-Z became a-z) and the window.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10

MAX_FINGERPRINTS = 500_000         # of the benchmark, to be sent to every executor: 8 MB
MAX_WINDOW_BYTES = 8_000_000       # of its windows' words, likewise

_RUN = "array<struct<size:int,hash:bigint,first:int,last:int>>"


def item_words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(ITEM_WORD), F.lit(0))


def _winnow(df: DataFrame, size: int, when: Column) -> DataFrame:
    """Add ``runs<size>``: the fingerprints of the windows of ``size`` words,
    where ``when`` holds.  Each array is a column of its own and read several
    times by the next, so it is computed once a row."""
    k = (size + 1) // 2
    w = size - k + 1
    words, grams, least, starts = F.col("__words"), F.col(f"__g{size}"), F.col(f"__m{size}"), F.col(f"__s{size}")
    n = F.size(words)
    some = when & (n >= size)

    def gram(i: Column) -> Column:
        return F.xxhash64(F.lit(size), *[F.get(words, i + j) for j in range(k)])

    def minimum(i: Column) -> Column:
        window = [F.get(grams, i + j) for j in range(w)]
        return F.least(*window) if w > 1 else window[0]

    df = df.withColumn(f"__g{size}", F.when(some, F.transform(F.sequence(F.lit(0), n - k), gram)))
    df = df.withColumn(f"__m{size}", F.when(some, F.transform(F.sequence(F.lit(0), n - size), minimum)))
    # A fingerprint starts where the least hash changes.
    df = df.withColumn(f"__s{size}", F.when(some, F.filter(
        F.sequence(F.lit(0), n - size), lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1)))))
    run = F.transform(starts, lambda s, j: F.struct(
        F.lit(size).alias("size"), F.get(least, s).alias("hash"), s.alias("first"),
        (F.coalesce(F.get(starts, j + 1), n - size + 1) - 1).alias("last")))
    return df.withColumn(f"__r{size}", F.coalesce(run, F.array().cast(_RUN)).cast(_RUN)).drop(
        f"__g{size}", f"__m{size}", f"__s{size}")


def _fingerprints(df: DataFrame, sizes: list[int], when=lambda size: F.lit(True)) -> DataFrame:
    """``df`` with ``__words`` plus ``runs``: the fingerprints for every window size."""
    for size in sizes:
        df = _winnow(df, size, when(size))
    runs = F.concat(*[F.col(f"__r{s}") for s in sizes]) if sizes else F.array().cast(_RUN)
    return df.withColumn("runs", runs).drop(*[f"__r{s}" for s in sizes])


def _span() -> Column:
    """The words of all windows of a run, as one text."""
    return F.array_join(F.slice("__words", F.col("run.first") + 1,
                                F.col("run.last") - F.col("run.first") + F.col("run.size")), " ")


def _windows(spans: DataFrame, *keep: str) -> DataFrame:
    """(keep, size, start, window) of every window in the spans (size, first, span)."""
    cut = spans.withColumn("w", F.split("span", " "))
    one = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("size")),
                      lambda i: F.array_join(F.slice(F.col("w"), i + 1, F.col("size")), " "))
    return (cut.select(*keep, "size", "first", F.posexplode_outer(one).alias("at", "window"))
            .select(*keep, "size", (F.col("first") + F.col("at")).alias("start"), "window"))


def _benchmark(benchmark: DataFrame) -> tuple[list[int], DataFrame, DataFrame, DataFrame]:
    """(window sizes, fingerprints, windows, windows with their items), each distinct."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("__words"))
             .filter(F.size("__words") > 0))
    items = staged(items, "bench_words")
    own = F.least(F.size("__words"), F.lit(WINDOW))
    sizes = sorted(r[0] for r in items.select(own).distinct().collect())   # ten at most
    runs = _fingerprints(items, sizes, lambda s: own == s)
    # An outer explode: the inner one adds a filter on the array, which is pushed down and computes it again.
    # Every item has a window, so it makes no row for an empty array.
    spans = staged(runs.select("item_id", "__words", F.explode_outer("runs").alias("run")).select(
        "item_id", F.col("run.size").alias("size"), F.col("run.hash").alias("hash"),
        F.col("run.first").alias("first"), _span().alias("span")), "bench_spans")
    named = staged(_windows(spans, "item_id").select("size", "window", "item_id").distinct(), "bench_windows")
    return sizes, spans.select("size", "hash").distinct(), named.select("size", "window").distinct(), named


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, spans (maximal runs of hit words, as
    [first, end) word positions) and items (ids of the items found, sorted as text)."""
    sizes, prints, windows, named = _benchmark(benchmark)
    few = prints.count() <= MAX_FINGERPRINTS
    light = (windows.agg(F.coalesce(F.sum(F.octet_length("window") + 16), F.lit(0))).first()[0] <= MAX_WINDOW_BYTES)
    per_doc = _fingerprints(docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                                        item_words(F.col("text")).alias("__words")), sizes)
    each = per_doc.select("row", "doc_id", "__words", F.size("__words").cast("long").alias("n_words"),
                          F.posexplode_outer("runs").alias("at", "run"))
    if not few:   # the words of a run travel with it; else they are cut only where it is hit
        each = each.withColumn("span", _span()).drop("__words")
    found = prints.select(F.col("size").alias("__size"), F.col("hash").alias("__hash"), F.lit(True).alias("hit"))
    met = each.join(_small(found, few), (F.col("run.size") == F.col("__size")) & (F.col("run.hash") == F.col("__hash")), "left")
    head = F.coalesce(F.col("at"), F.lit(0)) == 0
    rows = staged(met.filter(head | F.col("hit")).select(
        "row", "doc_id", "n_words", head.alias("head"), F.col("run.size").alias("size"), F.col("run.first").alias("first"),
        F.when(F.col("hit"), F.col("span") if not few else _span()).alias("span")), "doc_hits")

    hits = _windows(rows.filter(F.col("span").isNotNull()), "row")
    same = staged(hits.join(_small(windows, light), ["size", "window"], "left_semi"), "doc_windows")

    # Overlapping or touching windows make one span.
    before = Window.partitionBy("row").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    apart = F.coalesce(F.col("start") > F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = (same.select("row", "start", "size").distinct()
             .withColumn("new", apart.cast("int"))
             .withColumn("span", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("row", "span").agg(F.min("start").cast("long").alias("first"), F.max(end).cast("long").alias("end"))
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans")))
    items = (same.select("row", "size", "window").distinct()
             .join(_small(named, light and _light_items(named)), ["size", "window"])
             .filter(F.col("item_id").isNotNull()).select("row", "item_id").distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return (rows.filter("head").select("row", "doc_id", "n_words")
            .join(spans, "row", "left").join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _light_items(named: DataFrame) -> bool:
    size = F.octet_length("window") + F.octet_length(F.coalesce("item_id", F.lit(""))) + 24
    return named.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= MAX_WINDOW_BYTES


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT item_id, w, least(len(w), 10) AS m,
               unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
        FROM b WHERE len(w) > 0)),
hit AS (
  SELECT r, i, m, t
  FROM (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
        FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
              FROM d JOIN (SELECT DISTINCT m FROM bw) ON len(w) >= m))
  SEMI JOIN bw USING (m, t)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit JOIN bw USING (m, t) WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
