"""The flagship job: best image per hotel, reconciled with the current picks.

    images, tags, picks
      -> best tag per image (partial group limit)  -+
      -> dedupe images per id                       -+- join on image_id
      -> lifecycle filter -> features -> score (one projection)
      -> best per hotel (partial group limit)
      -> pick status / old score / new pick (joins, one row per key)
      -> updated picks, snapshot, change feed, metrics

Everything is a lazy DataFrame; ``Selection`` just names the relations.
``materialize`` writes what several outputs read as narrow tables in the
shared checkpoint folder: of the scored images the six columns that picking
and reconciling use, one row per hotel of the best picks, and one row per
current pick.  A lost executor costs a re-read, not a rerun.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.operators import outputs, reconcile, scoring
from curato.operators.ranking import dedupe_images
from curato.policy import Policy
from curato.session import stage


# What picking and reconciling read of a scored image.
STAGED_COLUMNS = ("image_id", "hotel_id", "is_active", "cdn_url", "image_score", "candidate")


class Selection:
    """The relations of one selection run, each built on first use (building
    a DataFrame costs driver-side analysis, so a caller that needs one output
    does not pay for the others)."""

    def __init__(self, images: DataFrame, scored_all: DataFrame, picks: DataFrame, policy: Policy,
                 materialize_status: bool, tables: list[str]):
        self.images = images                # deduplicated image records
        self.scored_all = scored_all        # every image scored, with a candidate flag
        self.tables = tables                # paths of the staged tables
        self._picks, self._policy, self._materialize = picks, policy, materialize_status

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, self.tables) if self._materialize else df

    @cached_property
    def scored(self) -> DataFrame:
        """Candidates with their scores."""
        return self.scored_all.filter(F.col("candidate")).drop("candidate")

    @cached_property
    def top(self) -> DataFrame:
        """Best candidate per hotel."""
        best = scoring.top_images(self.scored.select("hotel_id", "image_id", "image_score", "cdn_url"))
        return self._kept(best, "top")

    @cached_property
    def status(self) -> DataFrame:
        """Current picks + image state + old score + new pick + updated flag."""
        status = reconcile.with_updated_flag(
            reconcile.with_new_pick(reconcile.pick_status_scored(self._picks, self.scored_all), self.top))
        return self._kept(status, "status")

    @cached_property
    def updated_picks(self) -> DataFrame:
        """One row per current pick with the chosen image."""
        return reconcile.updated_picks(self.status, self._policy)

    @cached_property
    def snapshot(self) -> DataFrame:
        return outputs.snapshot(self.top)

    @cached_property
    def cdc(self) -> DataFrame:
        return outputs.cdc(self.status, self.top)

    @cached_property
    def metrics(self) -> DataFrame:
        return outputs.metrics(self.status, self.scored, self.top)


def select_and_reconcile(images: DataFrame, tags: DataFrame, picks: DataFrame,
                         policy: Policy = Policy(), materialize: bool | str = False,
                         tables: list[str] | None = None, join_key: str | None = None) -> Selection:
    """``materialize``: False keeps everything lazy; "scored" stages the
    scored images (read by the best-pick window and the pick status join);
    True also stages the best picks and the per-pick status, for runs that
    write several outputs from them.  ``tables`` collects the staged tables'
    paths, for a caller that deletes them.  ``join_key`` is the column that brings
    tags to images, the image id unless given."""
    if policy.variant != "A":
        raise ValueError("the flagship selection uses scorer A; see scoring.select_variant_b")
    imgs = dedupe_images(images)
    # Every image is scored once, with a candidate flag: the best-pick window
    # reads the candidates, and the picks need one join on the image id for
    # both the image's state and (for a candidate) its score.
    scored_all = scoring.score_images(
        scoring.tagged_images(imgs, tags, policy, dedupe=False, flag="candidate", join_key=join_key), policy)
    tables = [] if tables is None else tables
    if materialize:
        scored_all = stage(scored_all.select(*STAGED_COLUMNS), "scored", tables)
    return Selection(imgs, scored_all, picks, policy, materialize_status=materialize is True, tables=tables)
