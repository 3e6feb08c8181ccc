"""Scoring operators (features -> sub-scores -> composite -> rank / pick).

All of it is projections over Columns; the only shuffles are the ones a
ranking needs, and top-1 picks go through a partial group limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.functions import features as fx
from curato.operators.ranking import best_tag, dedupe_images, rank_in_group, top_in_group
from curato.operators.reconcile import is_candidate, with_lifecycle
from curato.policy import Policy

SCORE_COLUMNS = ["score_resolution", "score_aspect_ratio", "score_freshness", "score_tag_priority"]


def score_order(group_has_tag_columns: bool = False):
    """Best first; a null score ranks last; the image id breaks ties."""
    order = [F.col("image_score").desc_nulls_last(), F.col("image_id").asc_nulls_last()]
    if group_has_tag_columns:
        order += [F.col("probability").desc_nulls_last(), F.col("tag").asc_nulls_last(),
                  F.col("version").asc_nulls_last()]
    return order


def with_features(df: DataFrame, policy: Policy) -> DataFrame:
    """Resolution, aspect_ratio, freshness_days."""
    return df.withColumns({
        "resolution": fx.resolution(F.col("width"), F.col("height")),
        "aspect_ratio": fx.aspect_ratio(F.col("width"), F.col("height")),
        "freshness_days": fx.freshness_days(F.col("created_at"), policy),
    })


def with_sub_scores(df: DataFrame, policy: Policy) -> DataFrame:
    """The four sub-scores (needs the features)."""
    return df.withColumns({
        "score_resolution": fx.score_resolution(F.col("resolution"), policy),
        "score_aspect_ratio": fx.score_aspect_ratio(F.col("aspect_ratio"), policy),
        "score_freshness": fx.score_freshness(F.col("freshness_days"), policy),
        "score_tag_priority": fx.score_tag(F.col("probability"), policy),
    })


def with_composite(df: DataFrame, policy: Policy) -> DataFrame:
    """The weighted image score."""
    return df.withColumn("image_score", fx.composite(
        F.col("score_resolution"), F.col("score_aspect_ratio"), F.col("score_freshness"),
        F.col("score_tag_priority"), policy))


def score_images(df: DataFrame, policy: Policy) -> DataFrame:
    """W16-W18 in one projection."""
    return with_composite(with_sub_scores(with_features(df, policy), policy), policy)


def tagged_images(images: DataFrame, tags: DataFrame, policy: Policy, key: str = "image_id",
                  dedupe: bool = True, flag: str = "candidate", join_key: str | None = None) -> DataFrame:
    """W13+W14: one row per image with its best tag, its lifecycle class and
    a boolean ``flag`` telling whether it may be picked.

    Tags are cut to one row per image *before* the join, so a hot image id
    never fans out through the join; both join sides come out of a window
    on the image id and are already partitioned on it.

    ``join_key`` names another column that images and tags share (a content hash,
    say): an image's tags are then those with its value there.  All images of one
    value have the same tags, so tags are cut to one row per value.
    """
    on = join_key or key
    top_tag = best_tag(tags.select(on, "tag", "version", "probability"), on)
    imgs = dedupe_images(images, key) if dedupe else images
    out = with_lifecycle(imgs.join(top_tag, on, "left"))
    return out.withColumn(flag, is_candidate(F.col("change_type"), policy))


def tagged_candidates(images: DataFrame, tags: DataFrame, policy: Policy,
                      key: str = "image_id", dedupe: bool = True, join_key: str | None = None) -> DataFrame:
    """W13+W14+W15: the images that can be picked, with their best tag."""
    return (tagged_images(images, tags, policy, key, dedupe, flag="__candidate", join_key=join_key)
            .filter(F.col("__candidate")).drop("__candidate"))


def scored_candidates(images: DataFrame, tags: DataFrame, policy: Policy,
                      dedupe: bool = True, join_key: str | None = None) -> DataFrame:
    """Candidates with features, sub-scores and image_score (no rank yet)."""
    return score_images(tagged_candidates(images, tags, policy, dedupe=dedupe, join_key=join_key), policy)


def rank_images(scored: DataFrame, group: str = "hotel_id") -> DataFrame:
    """Rank of every candidate in its group, hot groups split."""
    return rank_in_group(scored, [group], score_order(), rank_col="rank")


def top_images(scored: DataFrame, group: str = "hotel_id") -> DataFrame:
    """The best candidate of each group."""
    return top_in_group(scored, [group], score_order())


def select_variant_b(images: DataFrame, tags: DataFrame, policy: Policy,
                     group: str = "hotel_id", key: str = "image_id") -> DataFrame:
    """The alternative scorer, best image per group.

    The original joins every tag row onto its image (k tags -> k candidates)
    and fills a missing probability with 0.  The score grows with the tag
    probability (the tag weight is not negative), so an image's best row is
    its most probable tag; the tags are reduced to that row first, which
    gives the same winners without the fan-out through the join.

    Every image given is scored, live or not: a caller that wants only live
    ones filters before.
    """
    if policy.variant != "B":
        raise ValueError("select_variant_b needs a policy with variant='B'")
    if policy.weights.tag < 0:
        raise ValueError("the tag weight must not be negative")
    t = tags.select(key, "tag", "version",
                    F.coalesce(F.col("probability").cast("double"), F.lit(0.0)).alias("probability"))
    top_tag = best_tag(t, key)
    joined = dedupe_images(images, key).join(top_tag, key, "left")
    joined = joined.withColumn("probability", F.coalesce(F.col("probability"), F.lit(0.0)))
    return top_in_group(score_images(joined, policy), [group], score_order(True))
