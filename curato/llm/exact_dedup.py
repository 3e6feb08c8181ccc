"""Exact dedup of arriving documents against immutable snapshots.

A snapshot is what earlier arrivals left: its exact buckets (one row per
distinct text: digest, the row that stays, the number of copies) and, per
bucket, a static binary-fuse filter over the bucket's digests.  Neither is
ever changed; a later arrival makes a snapshot of its own.

Method.  Arriving rows are first grouped among themselves by the digest of the
normalised text (copies inside the arrival are found here, and a text that
fills a third of the rows is one row from here on).  Each distinct digest is
then screened by its bucket's filter: about 0.4 % of the unseen digests pass
besides all the seen ones.  Only the passing digests are joined with the exact
buckets, and a digest found there counts as a copy only after the bytes of the
two normalised texts are compared.

Scale.  Filters are sharded by digest; the number of shards follows the number
of digests, so one filter covers about ``SHARD_KEYS`` keys whatever the input's
size, and nothing is broadcast or collected.  Texts move once: the rows named
by the passing pairs are fetched by row id for the byte comparison.

Defined cases.  A null text is the empty text.  Texts are equal when their
bytes are, after each run of ``[\\x20\\x09-\\x0D]`` became one space.  Of equal
texts the row with the smallest doc_id stays; a null doc_id comes last; of rows
that repeat a doc_id one stays.  An empty table gives an empty result.  Extra
columns are ignored by ``find_copies`` and kept by ``dedup_stage``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.llm.common import SPACE, numbered_rows, staged, table

SHARD_KEYS = 50_000
ARITY = 3


# -- the filter --------------------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, so each seed gives an independent-looking hash."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _layout(n: int) -> tuple[int, int]:
    """(segment length, segment count) for n keys: three neighbouring segments
    hold a key, and the table has about 1.13 slots a key (more for few keys)."""
    length = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    spare = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    count = max(1, -(-int(np.ceil(n * spare)) // length) - (ARITY - 1))
    return length, count


def _slots(h: np.ndarray, length: int, count: int) -> np.ndarray:
    """The three slots of each hash, one in each of three consecutive segments."""
    first = ((h >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    base = first.astype(np.int64) * length
    mask = np.uint64(length - 1)
    inner = [(h >> np.uint64(s)) & mask for s in (0, 11, 21)]
    return np.stack([base + i * length + x.astype(np.int64) for i, x in enumerate(inner)])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Binary-fuse filter of distinct uint64 keys as (seed, length, count, table).

    Construction peels, round by round, every key that is alone in one of its
    slots, then fills the slots in the opposite order.  Keys peeled in one
    round never share their free slots, so a round is a few array operations."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    length, count = _layout(len(keys))
    size = (count + ARITY - 1) * length
    for seed in range(1, 200):
        h = _mix(keys, seed)
        slots = _slots(h, length, count)
        degree = np.bincount(slots.ravel(), minlength=size)
        owners = np.zeros(size, dtype=np.int64)  # xor of the keys' indexes in a slot
        index = np.arange(len(keys))
        for row in slots:
            np.bitwise_xor.at(owners, row, index)
        rounds, left = [], len(keys)
        front = np.flatnonzero(degree == 1)
        while len(front):
            key, at = np.unique(owners[front], return_index=True)
            free = front[at]
            rounds.append((key, free))
            left -= len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(degree, touched, 1)
            np.bitwise_xor.at(owners, touched, np.tile(key, ARITY))
            touched = np.unique(touched)
            front = touched[degree[touched] == 1]
        if left == 0:
            prints, cells = _prints(h), np.zeros(size, dtype=np.uint8)
            for key, free in reversed(rounds):
                other = cells[slots[0, key]] ^ cells[slots[1, key]] ^ cells[slots[2, key]]
                cells[free] = prints[key] ^ other  # a free slot still holds 0
            return seed, length, count, cells.tobytes()
    raise RuntimeError("no seed gave a filter")


def in_filter(built: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    seed, length, count, cells = built
    cells = np.frombuffer(cells, dtype=np.uint8)
    h = _mix(np.asarray(keys, dtype=np.uint64), seed)
    a, b, c = _slots(h, length, count)
    return (cells[a] ^ cells[b] ^ cells[c]) == _prints(h)


# -- arrivals and snapshots ----------------------------------------------------

def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """One staged row per document: its row id, doc_id, digest and normalised text."""
    rows = docs.select("doc_id", normalised().alias("norm")).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.sha2("norm", 256).alias("sha"), "norm")
    return staged(rows, "digests")


def group_arrival(rows: DataFrame) -> DataFrame:
    """Copies inside one arrival: a row per digest with the row that stays."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    return rows.groupBy("sha").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("copies"))


def _key() -> Column:
    """The digest's first 60 bits as a number, for the filter."""
    return F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")


def _shard(shards: int) -> Column:
    return F.conv(F.substring("sha", 16, 8), 16, 10).cast("long") % shards


def shard_count(digests: int) -> int:
    return max(1, -(-digests // SHARD_KEYS))


def build_filters(buckets: DataFrame) -> DataFrame:
    """One filter a bucket: (shard, slice count is the reader's choice) -> its table."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, count, cells = build_filter(pdf["key"].to_numpy(np.uint64))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "seed": [seed], "length": [length],
                             "segments": [count], "cells": [cells]})
    return (buckets.select("shard", _key().alias("key")).groupBy("shard")
            .applyInPandas(build, "shard long, seed long, length long, segments long, cells binary"))


def make_snapshot(arrival: DataFrame, digests: int) -> tuple[DataFrame, DataFrame]:
    """(exact buckets, filters) of an arrival's groups, both written once."""
    buckets = staged(arrival.withColumn("shard", _shard(shard_count(digests))), "buckets")
    return buckets, staged(build_filters(buckets), "filters")


def screen(arrival: DataFrame, filters: DataFrame, shards: int, digests: int) -> DataFrame:
    """The arrival's digests that their bucket's filter lets through.

    An arrival larger than the snapshot is cut into slices of a bucket, each
    with a copy of the filter, so no task holds more than about SHARD_KEYS
    digests."""
    slices = max(1, -(-digests // (shards * SHARD_KEYS)))
    new = (arrival.withColumn("shard", _shard(shards))
           .withColumn("slice", F.conv(F.substring("sha", 24, 8), 16, 10).cast("long") % slices)
           .select("shard", "slice", "sha", _key().alias("key")))
    tables = filters.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) \
        .withColumn("slice", F.col("slice").cast("long"))

    def probe(keys: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        if not len(keys) or not len(built):
            return pd.DataFrame({"sha": pd.Series([], dtype=str)})
        f = built.iloc[0]
        hit = in_filter((int(f["seed"]), int(f["length"]), int(f["segments"]), f["cells"]),
                        keys["key"].to_numpy(np.uint64))
        return keys.loc[hit, ["sha"]]

    return (new.groupBy("shard", "slice").cogroup(tables.groupBy("shard", "slice"))
            .applyInPandas(probe, "sha string"))


def confirm(passed: DataFrame, arrival: DataFrame, buckets: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact-bucket join and byte check of the digests that passed the filter:
    the digests whose two texts are byte for byte the same."""
    pairs = (passed.join(arrival.select("sha", F.col("stays.row_id").alias("new")), "sha")
             .join(buckets.select("sha", F.col("stays.row_id").alias("old")), "sha"))
    wanted = pairs.select("sha", F.explode(F.array("new", "old")).alias("row_id"))
    return (wanted.join(rows.select("row_id", "norm"), "row_id").groupBy("sha")
            .agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
            .filter(F.col("a") == F.col("b")).select("sha"))


def find_copies(docs: DataFrame) -> DataFrame:
    """One row per document: row_id, doc_id, keep_id, group_size, kept, text_sha256."""
    return settle(digest_rows(docs))


def settle(rows: DataFrame) -> DataFrame:
    """``find_copies`` of digest rows (row_id, doc_id, sha, norm).  They arrive in
    two batches (dealt by a hash of the id): the first becomes the snapshot,
    the second is screened against it."""
    rows = rows.withColumn(
        "batch", F.when(F.pmod(F.xxhash64(F.lit("batch"), "doc_id"), F.lit(2)) == 0, 0).otherwise(1))
    narrow = rows.select("row_id", "doc_id", "sha", "batch")
    groups = [staged(group_arrival(narrow.filter(F.col("batch") == b)), f"arrival{b}") for b in (0, 1)]
    sizes = [g.count() for g in groups]
    buckets, filters = make_snapshot(groups[0], sizes[0])
    passed = screen(groups[1], filters, shard_count(sizes[0]), sizes[1])
    same = confirm(passed, groups[1], buckets, rows)
    met = staged(
        same.join(groups[1].select("sha", F.col("stays").alias("s1"), F.col("copies").alias("n1")), "sha")
        .join(buckets.select("sha", F.col("stays").alias("s0"), F.col("copies").alias("n0")), "sha")
        .select("sha", F.least("s0", "s1").alias("both_stay"), (F.col("n0") + F.col("n1")).alias("both_n")), "met")
    settled = [g.join(met, "sha", "left").select(
        "sha", F.lit(b).alias("batch"), F.coalesce("both_stay", "stays").alias("stays"),
        F.coalesce("both_n", "copies").alias("n")) for b, g in enumerate(groups)]
    return (narrow.join(settled[0].unionByName(settled[1]), ["sha", "batch"])
            .select("row_id", "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("row_id") == F.col("stays.row_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def dedup_stage(docs: DataFrame) -> DataFrame:
    """The documents without their copies, all columns as they came."""
    rows, needed = numbered_rows(docs, "dedup_in", "doc_id", "text")
    digests = needed.select(F.col("row").alias("row_id"), "doc_id", F.sha2(normalised(), 256).alias("sha"), normalised().alias("norm"))
    keep = settle(digests).filter("kept").select(F.col("row_id").alias("row"))
    return rows.join(keep, "row").select("user.*")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY sha ORDER BY doc_id NULLS LAST) AS k,
         first_value(doc_id) OVER (PARTITION BY sha ORDER BY doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY sha) AS n FROM d)
SELECT doc_id, keep_id, n AS group_size, k = 1 AS kept, sha AS text_sha256 FROM r
"""
