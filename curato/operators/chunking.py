"""Contiguous chunks by position (W09) and joins against chunk sets.

The original splits a file into n slices of ceil(N/n) lines in file order:
``chunks_by_position`` over numbered lines.  For tables, whose rows have no order of
their own, ``assign_chunks`` takes an explicit unique key: one range exchange plus
per-partition offsets, never a one-partition window over data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curato.operators.ranking import number_rows
from curato.session import stage


def assign_chunks(df: DataFrame, n: int, order: Sequence[Column],
                  chunk_col: str = "chunk_id", tables: list[str] | None = None) -> DataFrame:
    """Add ``chunk_col`` (1-based): the row at 0-based position i in ``order``
    goes to chunk ``i div ceil(N/n) + 1``.  As in the original this can give
    fewer than n chunks (9 rows, n = 6 -> chunks of 2 -> 5 chunks)."""
    if n <= 0:
        raise ValueError("the number of chunks must be positive")
    placed = number_rows(df, list(order), "__pos", "__total", tables=tables)
    size = F.ceil(F.col("__total") / F.lit(n))
    return placed.withColumn(chunk_col, (F.floor(F.col("__pos") / size) + 1).cast("int")).drop("__pos", "__total")


def chunks_by_position(lines: DataFrame, n: int, chunk_col: str = "chunk_id") -> DataFrame:
    """Add ``chunk_col`` to lines whose ``position`` (0 .. N - 1) is known, as
    ``feeds.number_lines`` gives it: slices of ceil(N/n) lines in file order.  No
    row moves; N is one number."""
    if n <= 0:
        raise ValueError("the number of chunks must be positive")
    total = lines.agg(F.max("position")).first()[0]
    size = -(-(0 if total is None else total + 1) // n) or 1
    return lines.withColumn(chunk_col, (F.expr(f"position div {size}") + 1).cast("int"))


def join_chunks(df: DataFrame, chunks: DataFrame, key: str, mode: str = "union",
                chunk_col: str = "chunk_id", tables: list[str] | None = None) -> DataFrame:
    """Join ``df`` with a set of chunks (rows tagged by ``chunk_col``).

    An empty chunk set leaves ``df`` as it is, in either mode.
    mode="union": one inner join with all chunks at once (the chunk id is
    kept), instead of the original's fold of joins, which on disjoint chunks
    returns nothing and repeats column names.
    mode="all": rows of ``df`` whose key occurs in every chunk (a semi join;
    no pairs are built).  The chunks are cut to their distinct (key, chunk)
    pairs once, and both counts are taken from that table.
    """
    if mode not in ("union", "all"):
        raise ValueError("mode must be 'union' or 'all'")
    if mode == "union":
        return df if chunks.isEmpty() else df.join(chunks, key, "inner")
    occurs = stage(chunks.select(key, chunk_col).distinct(), "chunk_keys", tables)
    total = occurs.agg(F.count_distinct(chunk_col)).first()[0]
    if total == 0:
        return df
    everywhere = (occurs.filter(F.col(chunk_col).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__in"))
                  .filter(F.col("__in") == total).select(key))
    return df.join(everywhere, key, "left_semi")


#: Rows of one key in one chunk above which the key is split over several tasks.
HOT_ROWS = 100_000


def fold_chunks(df: DataFrame, chunks: DataFrame, key: str, chunk_col: str = "chunk_id",
                hot_rows: int = HOT_ROWS, tables: list[str] | None = None) -> DataFrame:
    """W10, the literal fold: ``df`` joined with every chunk in turn on ``key``, each
    chunk's other columns renamed to ``<column>_<chunk>``.  A key's rows are all
    combinations of one row from ``df`` and one from each chunk.

    All joins share their key, so every row is shuffled once, however many chunks
    there are.  A key with more than ``hot_rows`` rows in one input would fill a
    task, and a chain of joins is not split at run time, so such a key gets a second key
    column: the rows of the input that has most of it are dealt over slices, and the
    other inputs' rows of the key are repeated in each slice.  Their number of
    keys is at most the rows divided by ``hot_rows``.  Null keys join nothing; no
    chunk at all leaves ``df`` as it is.  The inputs are staged, so a row keeps its
    slice when a task is run again."""
    df, chunks = stage(df, "fold_file", tables), stage(chunks, "fold_chunks", tables)
    ids = sorted(r[0] for r in chunks.select(chunk_col).distinct().collect() if r[0] is not None)
    if not ids:
        return df
    payload = [c for c in chunks.columns if c not in (key, chunk_col)]
    inputs = [df] + [chunks.filter(F.col(chunk_col) == i).select(key, *[F.col(c).alias(f"{c}_{i}") for c in payload])
                     for i in ids]
    counts = None
    for n, one in enumerate(inputs):
        part = one.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(
            F.col("__n") > hot_rows).withColumn("__most", F.lit(n))
        counts = part if counts is None else counts.unionByName(part)
    hot = stage(counts.groupBy(key).agg(F.max(F.struct("__n", "__most")).alias("__hot")).select(
        F.col(key).alias("__key"), F.ceil(F.col("__hot.__n") / hot_rows).cast("int").alias("__slices"),
        F.col("__hot.__most").alias("__most")), "fold_hot", tables)
    out = None
    for n, one in enumerate(inputs):
        dealt = F.array(F.pmod(F.monotonically_increasing_id(), F.col("__slices")).cast("int"))
        slices = (F.when(F.col("__slices").isNull(), F.array(F.lit(0)))
                  .when(F.col("__most") == n, dealt).otherwise(F.sequence(F.lit(0), F.col("__slices") - 1)))
        salted = (one.join(F.broadcast(hot), F.col(key) == F.col("__key"), "left")     # a row per hot_rows rows at most
                  .withColumn("__slice", F.explode(slices)).drop("__key", "__slices", "__most"))
        out = salted if out is None else out.join(salted, [key, "__slice"])
    return out.drop("__slice")
