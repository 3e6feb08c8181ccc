"""Reconciliation of the best candidates with the current picks.

Joins here are equi-joins with at most one row per key on the dimension side
(deduplicated images, one pick per hotel, one best image per hotel), so no
join multiplies rows.  No side is force-broadcast: adaptive execution turns a
join into a broadcast only when the measured side is under the threshold, and
splits a skewed partition otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.functions.lifecycle import DELETED, INACTIVE, active_flag, lifecycle, updated_flag
from curato.policy import Policy


def with_lifecycle(df: DataFrame, col: str = "is_active", out: str = "change_type") -> DataFrame:
    """W14."""
    return df.withColumn(out, lifecycle(F.col(col)))


def is_candidate(change_type: F.Column, policy: Policy) -> F.Column:
    """Inactive images are never picked; ones with a null flag ('deleted')
    are, unless the policy requires an active flag."""
    ok = change_type != F.lit(INACTIVE)
    if policy.require_active:
        ok = ok & (change_type != F.lit(DELETED))
    return ok


def candidates(df: DataFrame, policy: Policy) -> DataFrame:
    """The images that may be picked."""
    return with_lifecycle(df).filter(is_candidate(F.col("change_type"), policy))


def pick_status(picks: DataFrame, images: DataFrame, key: str = "image_id",
                keep: tuple[str, ...] = ("is_active", "cdn_url")) -> DataFrame:
    """Every current pick (its hotel and image id) with ``keep`` of its
    image's columns and the image's class.  A pick whose image is gone gets
    nulls and the class 'deleted'."""
    state = images.select(key, *[c for c in keep if c in images.columns])
    return with_lifecycle(picks.select("hotel_id", key).join(state, key, "left"))


def pick_status_scored(picks: DataFrame, scored_images: DataFrame, key: str = "image_id",
                       flag: str = "candidate") -> DataFrame:
    """W22+W23 in one join: the status, and for an image that is a candidate
    its score as ``old_image_score``.  ``scored_images`` holds every
    (deduplicated) image, scored, with a boolean ``flag`` for candidates."""
    old = F.when(F.col(flag), F.col("image_score")).alias("old_image_score")
    return pick_status(picks, scored_images.select(key, "is_active", "cdn_url", old), key,
                       ("is_active", "cdn_url", "old_image_score"))


def with_new_pick(df: DataFrame, top: DataFrame, group: str = "hotel_id") -> DataFrame:
    """The hotel's best candidate and its score, null when there is none."""
    best = top.select(group, F.col("image_id").alias("new_image_id"),
                      F.col("image_score").alias("new_image_score"),
                      F.col("cdn_url").alias("new_cdn_url"),
                      F.lit(True).alias("has_new_pick"))
    return df.join(best, group, "left")


def updated_picks(df: DataFrame, policy: Policy) -> DataFrame:
    """One row per current pick with the chosen image.

    By default the url is the new image's; ``legacy_url`` pairs the new id
    with the old image's url (null when that image is gone), as the original
    job did."""
    url = F.col("cdn_url") if policy.legacy_url else F.col("new_cdn_url")
    return df.select(F.col("new_image_id").alias("image_id"),
                     F.col("new_image_score").alias("image_score"),
                     "hotel_id", url.alias("cdn_url"))


def new_groups(scored: DataFrame, picks: DataFrame, group: str = "hotel_id") -> DataFrame:
    """Scored candidates of hotels that have no pick yet (all ranks)."""
    return scored.join(picks.select(group), group, "left_anti")


def groups_with_live_pick(images: DataFrame, picks: DataFrame, side: str = "images",
                          key: str = "image_id", group: str = "hotel_id") -> DataFrame:
    """Hotels whose current pick is an image not switched off.

    ``side='images'`` takes the hotel from the image record, ``side='picks'``
    from the pick.  A null flag passes neither filter (three-valued logic)."""
    if side == "images":
        joined = images.join(picks.select(key), key)
    elif side == "picks":
        joined = images.drop(group).join(picks.select(key, group), key)
    else:
        raise ValueError("side must be 'images' or 'picks'")
    return joined.filter(active_flag(F.col("is_active")) != F.lit(False)).select(group).distinct()


def with_updated_flag(df: DataFrame) -> DataFrame:
    """W28."""
    return df.withColumn("updated", updated_flag(F.col("change_type"), F.col("image_id"),
                                                 F.col("new_image_id")))
