"""Top-1 and full ranking within groups, safe against hot groups.

``top_in_group`` is ``row_number() = 1`` over a window; Catalyst turns it into
a partial ``WindowGroupLimit`` before the shuffle and a final one after it, so
a group holding a third of all rows still sends at most one row per map task.

``rank_in_group`` numbers *every* row of a group, and ``number_rows`` all rows.
A plain window would put a large group into one task.  Groups above a fair
share of a task are found by counting first; they are range-partitioned on (group,
order), which splits them over many partitions, and sorted there, so a row's
number is its place in the partition plus the group's rows in earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curato.session import stage

_GROUP = "__group"
_SEQ = "__seq"
_PART = "__part"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group: the first by ``order`` (which must end in a unique
    tie-breaker for a deterministic answer)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .drop("__rn"))


def best_tag(tags: DataFrame, key: str = "image_id") -> DataFrame:
    """The most probable tag of each image; ties go to the smaller tag, then
    the smaller version."""
    return top_in_group(tags, [key], [F.col("probability").desc_nulls_last(),
                                      F.col("tag").asc_nulls_last(),
                                      F.col("version").asc_nulls_last()])


def dedupe_images(images: DataFrame, key: str = "image_id") -> DataFrame:
    """One record per image id: the newest, then the smallest url."""
    return top_in_group(images, [key], [F.col("created_at").desc_nulls_last(),
                                        F.col("cdn_url").asc_nulls_last(),
                                        F.col("hash").asc_nulls_last()]
                        if "hash" in images.columns else
                        [F.col("created_at").desc_nulls_last(), F.col("cdn_url").asc_nulls_last()])


def _sorted_slices(df: DataFrame, n: int, keys: Sequence[Column], name: str, tables: list[str] | None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, staged with ``__seq``: the
    partition in the high bits, the place inside it in the low 33.  The staged table
    fixes which row sits where and survives a lost executor."""
    return stage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn(_SEQ, F.monotonically_increasing_id()), name, tables)


def _part() -> Column:
    return F.shiftright(_SEQ, 33)


def number_rows(df: DataFrame, order: Sequence[Column], position_col: str = "position", total_col: str | None = None,
                num_partitions: int | None = None, tables: list[str] | None = None) -> DataFrame:
    """Add ``position_col``: the 0-based place of each row in ``order`` (a total
    order), and its number of rows as ``total_col``.

    Each row moves once, in the range exchange; the rows before a partition are one
    number per partition, which is broadcast."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _sorted_slices(df, n, order, "numbered", tables)
    parts = rows.groupBy(_part().alias(_PART)).agg(F.min(_SEQ).alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = parts.select(_PART, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                          F.sum("__n").over(everything).alias("__whole"))                 # a row per partition
    out = rows.withColumn(_PART, _part()).join(F.broadcast(starts), _PART)
    out = out.withColumn(position_col, F.col("__before") + F.col(_SEQ) - F.col("__first"))
    if total_col:
        out = out.withColumn(total_col, F.col("__whole"))
    return out.drop(_PART, _SEQ, "__first", "__before", "__whole")


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  rank_col: str = "rank", size_col: str | None = None,
                  num_partitions: int | None = None, tables: list[str] | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row inside its group.

    ``order`` must be a total order inside a group (end it with a unique key).
    ``size_col``, if given, receives the number of rows of the group.  All
    columns of ``df`` are written once, so pass only the ones needed.

    Plan: staged rows -> group sizes (combined before their shuffle).  A group with
    more than half of a task's even share is hot; there are fewer than two per partition.
    All other groups go through one window, one hash exchange.  The rows of hot
    groups go through one range exchange on (group, order), sorted and staged,
    and the numbers that their slices start from, fewer than three per partition, are
    broadcast.  So each row moves once, and no task holds more than about its share.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(df.withColumn(_GROUP, F.struct(*_cols(group))), "ranked", tables)
    sizes = rows.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("__size"))
    hot = stage(sizes.filter(F.col("__size") > rows.count() / (2 * n)), "hot_groups", tables)
    found = hot.count()

    cold = rows
    if found:
        known = hot.withColumnRenamed(_GROUP, "__g")
        cold = rows.join(F.broadcast(known), F.col(_GROUP).eqNullSafe(F.col("__g")), "left_anti")
    own = Window.partitionBy(_GROUP)
    out = cold.withColumn(rank_col, F.row_number().over(own.orderBy(*order)).cast("long"))
    if size_col:
        out = out.withColumn(size_col, F.count(F.lit(1)).over(own))
    if found:
        out = out.unionByName(_rank_hot(
            rows.join(F.broadcast(known.drop("__size")), F.col(_GROUP).eqNullSafe(F.col("__g")), "left_semi"),
            n, order, rank_col, size_col, tables))
    return out.drop(_GROUP)


def _rank_hot(rows: DataFrame, n: int, order: Sequence[Column], rank_col: str, size_col: str | None,
              tables: list[str] | None) -> DataFrame:
    ranged = _sorted_slices(rows, n, [F.col(_GROUP), *order], "ranged", tables)
    slices = ranged.groupBy(_part().alias(_PART), _GROUP).agg(F.min(_SEQ).alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(_GROUP).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(F.col(_PART).alias("__p"), F.col(_GROUP).alias("__g"), "__first",
                           F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                           F.sum("__n").over(Window.partitionBy(_GROUP)).alias("__whole"))
    out = ranged.join(F.broadcast(starts), (_part() == F.col("__p")) & F.col(_GROUP).eqNullSafe(F.col("__g")))
    out = out.withColumn(rank_col, F.col("__before") + F.col(_SEQ) - F.col("__first") + 1)
    if size_col:
        out = out.withColumn(size_col, F.col("__whole"))
    return out.drop(_SEQ, "__p", "__g", "__first", "__before", "__whole")
