"""Run metrics as relations (W29-W33); each is one partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.functions.lifecycle import DELETED, active_flag


def deleted_picks(status: DataFrame) -> DataFrame:
    """Current picks whose image is gone or has a null flag."""
    return status.agg(F.count_if(F.col("change_type") == F.lit(DELETED)).cast("long").alias("n"))


def images_processed(scored: DataFrame, key: str = "image_id") -> DataFrame:
    """Distinct candidate ids (a null id counts as one value)."""
    return scored.select(key).distinct().agg(F.count(F.lit(1)).cast("long").alias("n"))


def picks_by_flag(flagged: DataFrame) -> DataFrame:
    """Current picks by the updated flag."""
    return flagged.groupBy("updated").agg(F.count(F.lit(1)).cast("long").alias("n"))


def distinct_flags(images: DataFrame) -> DataFrame:
    """The distinct active-flag values of the image feed."""
    return images.select(active_flag(F.col("is_active")).alias("is_active")).distinct()


def join_counts(left: DataFrame, right: DataFrame, key: str, chunk: DataFrame | None = None) -> DataFrame:
    """Row counts of both inputs, of their inner join and (optionally) of
    one chunk joined with the right side, as (metric, value) rows.

    The sides' keys are marked and counted together, one row per key; a join's
    count is the sum over keys of the product of both sides' counts, so each
    side is read once and no pair is materialised even for a hot key."""
    sides = {"l": left, "r": right} | ({"c": chunk} if chunk is not None else {})
    marked = None
    for name, side in sides.items():
        rows = side.select(F.col(key).alias("k"), *[F.lit(int(name == s)).alias(s) for s in sides])
        marked = rows if marked is None else marked.unionByName(rows)
    per_key = marked.groupBy("k").agg(*[F.sum(s).alias(s) for s in sides])
    paired = F.col("k").isNotNull()
    counts = {"left_rows": F.sum("l"), "right_rows": F.sum("r"),
              "joined_rows": F.sum(F.when(paired, F.col("l") * F.col("r")))}
    if chunk is not None:
        counts["chunk_joined_rows"] = F.sum(F.when(paired, F.col("c") * F.col("r")))
    return as_rows(per_key.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(n) for n, v in counts.items()]))


def as_rows(one: DataFrame) -> DataFrame:
    """A single row of counts as (metric, value) rows."""
    return one.select(F.inline(F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in one.columns])))
