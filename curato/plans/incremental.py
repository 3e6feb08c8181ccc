"""Best picks kept up to date from feed deltas, without scoring every image again.

The state holds, for each hotel, its ``k`` best candidates in order.  A delta is the
scored images that changed: new ones, ones with another record or other tags, ones that
may no longer be picked, and the places that moved images left.  For the hotels
that it names, changed images leave the hotel's list, those that may be picked come in
again, and the list is cut to ``k``.

A list that was cut is not ``complete``: other candidates exist that rank after its
``bound``, the last entry when it was cut.  Entries up to the bound are certain, since all
that is not listed ranks after it; a changed image that ranks after the bound
is left out, as it cannot be told from those.  So the first entry is the best candidate
as long as the list has one.  A list that runs empty without being complete is
rebuilt from all images of that hotel, which ``full`` gives; no other hotel is read.

The state lies in bucket folders by a hash of the hotel.  An update reads the buckets of
the hotels in the delta, writes these anew beside the old ones, and one small file, replaced
by a rename, says which folder of each bucket holds: a failed update leaves the state as
it was, and readers see one state.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.operators import scoring
from curato.policy import Policy
from curato.session import drop_tables, stage
from curato.sources.commits import CURRENT, _read_text, _replace_text

K = 8
BUCKETS = 256


def _entry() -> Column:
    """A candidate as a struct that sorts best first: known scores, high scores, small ids."""
    return F.struct(F.col("image_score").isNull().alias("unscored"), (-F.col("image_score")).alias("down"), "image_id",
                    "image_score", "cdn_url")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("hotel_id"), F.lit(buckets)).cast("int")


def _best(candidates: DataFrame, n: int) -> DataFrame:
    """(hotel_id, entries): the first ``n`` candidates of each hotel.  Map tasks keep ``n`` a
    hotel before the shuffle."""
    ranked = Window.partitionBy("hotel_id").orderBy("entry")
    return (candidates.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= n)
            .groupBy("hotel_id").agg(F.sort_array(F.collect_list("entry")).alias("entries")))


def _cut(lists: DataFrame, k: int) -> DataFrame:
    """Lists of up to k + 1 entries -> state rows.  ``bound`` and ``complete`` are those from before."""
    cut = F.size("entries") > k
    last = F.element_at("entries", k)
    bound = F.struct(last["unscored"].alias("unscored"), last["down"].alias("down"), last["image_id"].alias("image_id"))
    return lists.select("hotel_id", F.when(cut, F.slice("entries", 1, k)).otherwise(F.col("entries")).alias("entries"),
                        (F.col("complete") & ~cut).alias("complete"), F.when(cut, bound).otherwise(F.col("bound")).alias("bound"))


@dataclass(frozen=True)
class PickState:
    """The state in one folder."""

    spark: SparkSession
    path: str
    k: int
    buckets: int
    folders: dict[int, str]      # bucket -> the folder that holds it

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PickState:
        text = _read_text(spark, f"{path.rstrip('/')}/{CURRENT}")
        if text is None:
            raise ValueError(f"{path} holds no state")
        s = json.loads(text)
        return cls(spark, path.rstrip("/"), s["k"], s["buckets"], {int(b): f for b, f in s["folders"].items()})

    @classmethod
    def build(cls, candidates: DataFrame, path: str, k: int = K, buckets: int = BUCKETS) -> PickState:
        """The state of all candidates (hotel_id, image_id, image_score, cdn_url)."""
        if k < 1 or buckets < 1:
            raise ValueError("a state holds at least one candidate and one bucket")
        spark = candidates.sparkSession
        empty = cls(spark, path.rstrip("/"), k, buckets, {})
        return empty._write(empty._fresh(candidates), [])

    def _fresh(self, candidates: DataFrame) -> DataFrame:
        rows = candidates.select("hotel_id", _entry().alias("entry"))
        bound = "struct<unscored:boolean,down:double,image_id:{}>".format(dict(candidates.dtypes)["image_id"])
        return _cut(_best(rows, self.k + 1).withColumns(
            {"complete": F.lit(True), "bound": F.lit(None).cast(bound)}), self.k)

    def _write(self, rows: DataFrame, replaced: Iterable[int]) -> PickState:
        run = os.urandom(8).hex()
        target = f"{self.path}/runs/{run}"
        dealt = rows.withColumn("bucket", _bucket(self.buckets))
        dealt.repartition("bucket").write.partitionBy("bucket").parquet(target)
        there = self.spark.read.schema(dealt.schema).parquet(target).select("bucket").distinct().collect()   # ``buckets`` rows at most
        folders = {b: f for b, f in self.folders.items() if b not in set(replaced)}
        folders |= {r["bucket"]: f"runs/{run}/bucket={r['bucket']}" for r in there}
        _replace_text(self.spark, f"{self.path}/{CURRENT}",
                      json.dumps({"k": self.k, "buckets": self.buckets, "folders": folders}))
        return PickState(self.spark, self.path, self.k, self.buckets, folders)

    def rows(self, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """State rows of the buckets (all by default); none where nothing is held."""
        wanted = self.folders if buckets is None else {b: self.folders[b] for b in buckets if b in self.folders}
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in wanted.values()]) if wanted else None

    def top(self) -> DataFrame:
        """The best candidate of each hotel: hotel_id, image_id, image_score, cdn_url."""
        rows = self.rows()
        if rows is None:
            raise ValueError("the state holds no hotel")
        best = F.col("entries")[0]
        return rows.select("hotel_id", *[best[c].alias(c) for c in ("image_id", "image_score", "cdn_url")])

    def update(self, delta: DataFrame, full: Callable[[DataFrame], DataFrame]) -> tuple[PickState, DataFrame]:
        """Apply a delta (hotel_id, image_id, image_score, cdn_url, candidate; one row per
        hotel and image).  ``full`` gives all candidates, as they are after the delta, of
        the hotels in a DataFrame (hotel_id).  Returns the new state and the hotels whose pick
        changed: hotel_id, old_image_id, new_image_id, new_score, cdn_url.  That table
        outlives the update; the others do not."""
        tables: list[str] = []
        try:
            delta = stage(delta.select("hotel_id", "image_id", F.col("candidate"), _entry().alias("entry"))
                          .withColumn("bucket", _bucket(self.buckets)), "delta", tables)
            touched = [r["bucket"] for r in delta.select("bucket").distinct().collect()]  # ``buckets`` rows at most
            hotels = delta.select("hotel_id").distinct()
            old = self.rows(touched)
            if old is None:
                old = self._fresh(self.spark.createDataFrame([], "hotel_id {}, image_id {}, image_score double, cdn_url string".format(
                    *[dict(delta.dtypes)[c] for c in ("hotel_id", "image_id")])))
            mine = old.join(hotels, "hotel_id", "left_semi")
            held = (mine.select("hotel_id", F.explode("entries").alias("entry")).withColumn("image_id", F.col("entry.image_id"))
                    .join(delta.select("hotel_id", "image_id"), ["hotel_id", "image_id"], "left_anti"))
            key = F.struct("entry.unscored", "entry.down", "entry.image_id")
            limits = mine.select("hotel_id", "complete", "bound")
            come = (delta.filter("candidate").select("hotel_id", "entry").join(limits, "hotel_id", "left")
                    .filter(F.coalesce("complete", F.lit(True)) | (key <= F.col("bound"))))
            lists = _best(held.select("hotel_id", "entry").unionByName(come.select("hotel_id", "entry")), self.k + 1)
            merged = hotels.join(lists, "hotel_id", "left").join(limits, "hotel_id", "left")
            none = F.array().cast(old.schema["entries"].dataType)
            merged = stage(_cut(merged.withColumns({"entries": F.coalesce("entries", none),
                                                    "complete": F.coalesce("complete", F.lit(True))}), self.k), "merged", tables)
            empty = F.size("entries") == 0
            lost = merged.filter(empty & ~F.col("complete")).select("hotel_id")
            rebuilt = self._fresh(full(lost).join(lost, "hotel_id", "left_semi"))
            new = stage(merged.filter(~empty).unionByName(rebuilt), "picked", tables)
            state = self._write(old.join(hotels, "hotel_id", "left_anti").unionByName(new), touched)
            first, before = F.col("entries")[0], mine.select("hotel_id", F.col("entries")[0]["image_id"].alias("old_image_id"))
            after = new.select("hotel_id", first["image_id"].alias("new_image_id"), first["image_score"].alias("new_score"),
                               first["cdn_url"].alias("cdn_url"))
            changes = (hotels.join(before, "hotel_id", "left").join(after, "hotel_id", "left")
                       .filter(~F.col("old_image_id").eqNullSafe(F.col("new_image_id"))))
            return state, stage(changes, "pick_changes")
        finally:
            drop_tables(self.spark, tables)

    def vacuum(self) -> None:
        """Delete the folders that the state no longer uses (once their readers have ended)."""
        from curato.sources.commits import _files
        used = set(self.folders.values())
        fs, runs = _files(self.spark, f"{self.path}/runs")
        for run in fs.listStatus(runs) if fs.exists(runs) else []:
            for part in fs.listStatus(run.getPath()):
                name = f"runs/{run.getPath().getName()}/{part.getPath().getName()}"
                if part.isDirectory() and name not in used:
                    fs.delete(part.getPath(), True)


def scored_delta(images: DataFrame, tags: DataFrame, policy: Policy, moved: DataFrame | None = None) -> DataFrame:
    """The delta of changed image records: each scored with its best tag, which is looked up
    for these images only.  ``moved`` (hotel_id, image_id) names places that images left."""
    own = tags.join(images.select("image_id").distinct(), "image_id", "left_semi")
    scored = scoring.score_images(scoring.tagged_images(images, own, policy), policy)
    out = scored.select("hotel_id", "image_id", "image_score", "cdn_url", "candidate")
    if moved is None:
        return out
    gone = moved.select("hotel_id", "image_id").distinct().join(out, ["hotel_id", "image_id"], "left_anti")
    return out.unionByName(gone.withColumns({"image_score": F.lit(None).cast("double"), "cdn_url": F.lit(None).cast("string"),
                                             "candidate": F.lit(False)}))
