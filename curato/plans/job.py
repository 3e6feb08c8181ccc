"""The file-to-file job: JSON-lines feeds in, refreshed picks and run outputs out.

    images.jsonl, image_tags.jsonl, main_images.jsonl
      -> contract check per feed (the default contract, or a JSON-Schema
         document), written once as a validity-partitioned table
         (typed valid rows; rejected lines with reasons)
      -> select_and_reconcile (scored images, best picks and status staged)
      -> updated_main_images         key/value JSON lines, one per current pick
         snapshot, cdc, metrics      JSON lines
         rejected_<feed>             lines that broke their contract, with file and line number
         violations_<feed>           one JSON line per violation: where, which rule, expected, found

The outputs go to <out>/runs/<run>/<name> and become current together when the last
one is written; ``commits.read_output(spark, out, name)`` reads the current ones, and a
run that fails leaves them as they were.  Inputs are never modified.
Each output is one Spark write; every line is
parsed and checked once, and the relations the outputs share are staged, so
the scans and the ranking shuffles run once per job.  The staged tables are
deleted when the job ends, also when it fails.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.functions.contract import Contract
from curato.operators import validate
from curato.plans.selection import select_and_reconcile
from curato.policy import Policy
from curato.session import drop_tables, scratch_path
from curato.sources import contracts, sinks
from curato.sources.commits import Commit
from curato.sources.feeds import number_lines, read_lines, read_split_lines, split_starts, with_places


@dataclass(frozen=True)
class JobResult:
    """Paths of the outputs, and of each feed's rejected lines."""

    outputs: dict[str, str]
    rejected: dict[str, str]


def _contract(stated: Contract | Mapping | None, name: str) -> Contract:
    """A feed's contract: as given, from a JSON-Schema document, or the default."""
    if stated is None:
        return contracts.FEEDS[name][0]
    return stated if isinstance(stated, Contract) else Contract.from_json_schema(stated, name)


def stage_feed(spark: SparkSession, path: str, name: str, glob: str | None = None,
               contract: Contract | Mapping | None = None, record: list[str] | None = None,
               repeated: str = "reject") -> DataFrame:
    """Parse and check a feed once, and write it once as a table in the
    shared checkpoint folder, partitioned by validity: valid lines as typed
    columns (columnar, far smaller than the JSON text), rejected lines as
    the raw line, its reasons and its violations in detail, and blank lines (validity
    null) as nothing but their place.  Everything downstream reads this table,
    so no line is parsed or checked twice and the lineage is cut here."""
    _, fields, _ = contracts.FEEDS[name]
    checked = validate.check_contract(read_split_lines(spark, path, glob), _contract(contract, name), detail=True,
                                      repeated=repeated, tables=record, keep_blank=True)
    ok = F.when(~validate.is_blank(), F.size(F.col("violations")) == 0)
    staged = checked.select(
        ok.alias("valid"), "file", "block", "seq",
        *[F.when(ok, c).alias(n) for n, c in fields().items()],
        F.when(~ok, F.col("value")).alias("value"),
        F.when(~ok, F.array_join(F.col("violations"), ";")).alias("reasons"),
        F.when(~ok, F.col("details")).alias("details"))
    target = scratch_path(spark, f"feed-{name}")
    if record is not None:
        record.append(target)
    staged.write.partitionBy("valid").parquet(target)
    return spark.read.schema(staged.schema).parquet(target)


def load_feed(spark: SparkSession, path: str, name: str, glob: str | None = None,
              contract: Contract | Mapping | None = None, record: list[str] | None = None,
              repeated: str = "reject"):
    """(staged table, typed valid rows, rejected lines) of one feed."""
    _, fields, after = contracts.FEEDS[name]
    table = stage_feed(spark, path, name, glob, contract, record, repeated)
    valid = after(table.filter(F.col("valid")).select(*fields().keys()))
    rejected = table.filter(~F.col("valid")).select("value", "reasons")
    return table, valid, rejected


def located_rejects(table: DataFrame, record: list[str] | None = None) -> DataFrame:
    """The rejected lines of a staged feed with file, line (from 1), value, reasons and
    details (for ``validate.violation_report``)."""
    starts = split_starts(table.select("file", "block", "seq"), record)
    return with_places(table.filter(~F.col("valid")).select("file", "block", "seq", "value", "reasons", "details"),
                       starts).select("file", "line", "value", "reasons", "details")


def feed_counts(name: str, table: DataFrame) -> DataFrame:
    """Valid and rejected line counts of a staged feed (reads only the
    partition column)."""
    ok = F.col("valid")
    return table.agg(F.count_if(ok).cast("long").alias("valid"),
                     F.count_if(~ok).cast("long").alias("rejected")).select(
        F.explode(F.array(
            F.struct(F.lit(f"{name}_valid").alias("metric"), F.col("valid").alias("value")),
            F.struct(F.lit(f"{name}_rejected").alias("metric"), F.col("rejected").alias("value")))).alias("m")
    ).select("m.metric", "m.value")


def validation_gate(spark: SparkSession, feeds: dict[str, tuple[str, object]],
                    fail_on_reject: bool = False) -> DataFrame:
    """Check several feeds against their contracts: (feed, metric, value)
    rows of valid and rejected line counts.  With ``fail_on_reject`` the
    (tiny) result is collected and a feed with rejected lines raises."""
    parts = []
    for name, (path, contract) in feeds.items():
        checked = validate.check_contract(read_lines(spark, path), contract)
        counts = checked.select((F.size(F.col("violations")) == 0).alias("valid"))
        parts.append(feed_counts(name, counts).withColumn("feed", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("feed", "metric", "value")
    if fail_on_reject:
        bad = [r.feed for r in out.filter(F.col("metric").endswith("_rejected") & (F.col("value") > 0)).collect()]
        if bad:
            raise ValueError(f"feeds with rejected lines: {', '.join(sorted(bad))}")
    return out


def split_feeds(spark: SparkSession, images_path: str, tags_path: str, which: str | None, n: int,
                out_dir: str, split_size: str | None = None) -> dict[str, str]:
    """Write the chosen feeds ('images', 'tags', 'both') as n contiguous chunks
    each, in file order.  Spark needs no chunking to join; this only serves
    consumers that want fixed-size pieces.  ``split_size``: see ``number_lines``."""
    choices = {"images": ["images"], "tags": ["tags"], "both": ["images", "tags"]}
    if which is None:
        return {}
    if which not in choices:
        raise ValueError(f"which must be one of {sorted(choices)} or None")
    paths = {"images": images_path, "tags": tags_path}
    out, tables = {}, []
    try:
        for name in choices[which]:
            target = f"{out_dir.rstrip('/')}/{name}_chunks"
            sinks.write_file_chunks(number_lines(spark, paths[name], tables=tables, split_size=split_size), n, target)
            out[name] = target
    finally:
        drop_tables(spark, tables)
    return out


def run_job(spark: SparkSession, images_path: str, tags_path: str, picks_path: str, out_dir: str,
            policy: Policy = Policy(), glob: str | None = None,
            feed_contracts: Mapping[str, Contract | Mapping] | None = None, repeated: str = "reject",
            join_key: str | None = None) -> JobResult:
    """``feed_contracts`` gives the contract, or the JSON-Schema document, of
    the feeds ('images', 'image_tags', 'main_images') that do not use the default.
    ``repeated`` says what a key that a line repeats does: 'reject' the line, or keep
    its 'last' value.  ``join_key`` brings tags to images by another column than the
    image id.  All outputs become current together (``sources.commits``)."""
    stated = dict(feed_contracts or {})
    feeds = {"images": images_path, "image_tags": tags_path, "main_images": picks_path}
    if set(stated) - set(feeds):
        raise ValueError(f"contracts for unknown feeds: {sorted(set(stated) - set(feeds))}")
    tables: list[str] = []
    try:
        with Commit(spark, out_dir) as commit:
            typed, rejected, counts = {}, {}, []
            for name, path in feeds.items():
                table, typed[name], _ = load_feed(spark, path, name, glob, stated.get(name), tables, repeated)
                rejected[name] = located_rejects(table, tables)
                counts.append(feed_counts(name, table))
            sel = select_and_reconcile(typed["images"], typed["image_tags"], typed["main_images"], policy,
                                       materialize=True, tables=tables, join_key=join_key)
            paths = {n: commit.path(n) for n in ("updated_main_images", "snapshot", "cdc", "metrics")}
            sinks.write_key_value(sel.updated_picks, paths["updated_main_images"])
            sinks.write_jsonl(sel.snapshot, paths["snapshot"])
            sinks.write_jsonl(sel.cdc, paths["cdc"])
            metrics = sel.metrics
            for c in counts:
                metrics = metrics.unionByName(c)
            sinks.write_jsonl(metrics.coalesce(1), paths["metrics"])   # a handful of rows
            for name, bad in rejected.items():
                paths[f"rejected_{name}"] = commit.path(f"rejected_{name}")
                sinks.write_jsonl(bad.drop("details"), paths[f"rejected_{name}"])
                paths[f"violations_{name}"] = commit.path(f"violations_{name}")
                sinks.write_jsonl(validate.violation_report(bad, "file", "line"), paths[f"violations_{name}"])
            commit.publish()
    finally:
        drop_tables(spark, tables)
    return JobResult(outputs=paths, rejected={n: paths[f"rejected_{n}"] for n in feeds})


def read_schema(spark: SparkSession, path: str) -> dict:
    """A JSON-Schema document, wherever Spark can read it."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Pick the best image per hotel and reconcile with the current picks.")
    ap.add_argument("--images", required=True, help="images JSONL file, directory or glob")
    ap.add_argument("--tags", required=True, help="image tags JSONL file, directory or glob")
    ap.add_argument("--main_images", required=True, help="current picks JSONL file, directory or glob")
    ap.add_argument("--out", default="output", help="output folder")
    ap.add_argument("--as_of", default=None, help="date freshness is measured from (YYYY-MM-DD); default today")
    ap.add_argument("--legacy_url", action="store_true", help="pair the new pick with the old pick's url")
    for feed in contracts.FEEDS:
        ap.add_argument(f"--{feed}_schema", default=None, help=f"JSON-Schema document of the {feed} feed")
    ap.add_argument("--repeated_keys", choices=("reject", "last"), default="reject",
                    help="reject a line that repeats a key, or keep the key's last value")
    args = ap.parse_args(argv)
    import datetime as dt
    from curato.session import build_session
    policy = Policy(as_of=dt.date.fromisoformat(args.as_of) if args.as_of else None, legacy_url=args.legacy_url)
    spark = build_session(app_name="curato-job")
    try:
        given = {feed: getattr(args, f"{feed}_schema") for feed in contracts.FEEDS}
        res = run_job(spark, args.images, args.tags, args.main_images, args.out, policy,
                      feed_contracts={f: read_schema(spark, p) for f, p in given.items() if p},
                      repeated=args.repeated_keys)
        for k, v in res.outputs.items():
            print(f"{k}: {v}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
