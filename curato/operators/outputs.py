"""Run outputs: next-state snapshot, change feed and metrics.

The original job announces all three but writes only the refreshed picks;
their shape here is ours:

* snapshot(hotel_id, image_id, cdn_url, image_score): one row per hotel that
  has a best candidate.
* cdc(op, hotel_id, old_image_id, new_image_id, old_score, new_score, reason):
  insert = hotel without a pick that has a candidate; update = old and new
  image differ (null-safe), both present; delete = hotel with a pick but no
  candidate.  Unchanged hotels give no row.  ``reason`` is the old pick's
  lifecycle class, 'new' for inserts.  Applying it to the old picks gives the
  snapshot's (hotel, image) pairs.
* metrics(metric, value): one row per count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.operators.metrics import as_rows

# Change feed operations.
INSERT = "insert"
UPDATE = "update"
DELETE = "delete"


def snapshot(top: DataFrame, group: str = "hotel_id") -> DataFrame:
    return top.select(group, "image_id", "cdn_url", "image_score")


def _operation() -> F.Column:
    """What the change feed says about a current pick; null for no change."""
    return (F.when(F.col("has_new_pick").isNull(), F.lit(DELETE))
            .when(~F.col("image_id").eqNullSafe(F.col("new_image_id")), F.lit(UPDATE)))


def cdc(status: DataFrame, top: DataFrame, group: str = "hotel_id") -> DataFrame:
    """``status`` has one row per current pick with image_id, change_type,
    old_image_score and the hotel's new pick (``with_new_pick``); ``top`` one
    row per hotel with its best candidate.

    Updates and deletes come from ``status`` itself (its left join with the
    best picks is one AQE can split when a hotel is hot); inserts are best
    picks of hotels with no current pick, an anti join against the distinct
    picked hotels.  No full outer join, whose skewed partitions AQE cannot
    split."""
    old_side = (status.withColumn("op", _operation()).filter(F.col("op").isNotNull())
                .select("op", group, F.col("image_id").alias("old_image_id"), "new_image_id",
                        F.col("old_image_score").alias("old_score"),
                        F.col("new_image_score").alias("new_score"),
                        F.coalesce(F.col("change_type"), F.lit("deleted")).alias("reason")))
    inserts = (_inserted(status, top, group)
               .select(F.lit(INSERT).alias("op"), group, F.lit(None).cast(status.schema["image_id"].dataType)
                       .alias("old_image_id"), F.col("image_id").alias("new_image_id"),
                       F.lit(None).cast("double").alias("old_score"), F.col("image_score").alias("new_score"),
                       F.lit("new").alias("reason")))
    return old_side.unionByName(inserts)


def _inserted(status: DataFrame, top: DataFrame, group: str) -> DataFrame:
    return top.join(status.select(group).distinct(), group, "left_anti")


def metrics(status: DataFrame, scored: DataFrame, top: DataFrame, group: str = "hotel_id") -> DataFrame:
    """One row per metric.  All counts over the picks, the feed's updates
    and deletes among them, are one aggregate of ``status``; the picked hotels
    are met with ``top`` once, which gives the inserts and the snapshot's size.
    The three one-row aggregates are unioned: no driver round trip."""
    op = _operation()
    of_picks = status.agg(
        F.count_if(F.col("change_type") == "deleted").alias("picks_deleted"),
        F.count_if(F.col("updated")).alias("picks_updated"),
        F.count_if(~F.col("updated")).alias("picks_unchanged"),
        F.count_if(op == UPDATE).alias("cdc_updates"), F.count_if(op == DELETE).alias("cdc_deletes"))
    of_images = scored.select("image_id").distinct().agg(F.count(F.lit(1)).alias("images_processed"))
    picked = status.select(group).distinct().withColumn("__picked", F.lit(True))
    of_top = top.select(group).join(picked, group, "left").agg(
        F.count_if(F.col("__picked").isNull()).alias("cdc_inserts"), F.count(F.lit(1)).alias("snapshot_rows"))
    return as_rows(of_picks).unionByName(as_rows(of_images)).unionByName(as_rows(of_top))


def apply_cdc(old_picks: DataFrame, feed: DataFrame, group: str = "hotel_id") -> DataFrame:
    """Apply a change feed to (hotel_id, image_id) picks: the check that the
    feed and the snapshot agree.  Picks of hotels the feed touches are
    replaced by its inserts and updates (deletes leave nothing)."""
    touched = feed.select(group).distinct()
    kept = old_picks.select(group, "image_id").join(touched, group, "left_anti")
    upserts = feed.filter(F.col("op").isin(INSERT, UPDATE)).select(group, F.col("new_image_id").alias("image_id"))
    return kept.unionByName(upserts)
