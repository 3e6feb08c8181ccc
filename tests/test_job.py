"""The file-to-file job on JSON-lines feeds made from the smallest tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from curato.operators import outputs
from curato.plans.job import run_job
from curato.plans.selection import select_and_reconcile
from curato.policy import Policy
from curato.sources.feeds import IMAGES_SCHEMA, read_chunk_dir
from curato.sources.tables import images_view, picks_view, tags_view

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
POLICY = Policy(as_of=dt.date(2006, 1, 1), score_digits=6)


def write_feeds(spark, tmp_dir):
    images = images_view(spark, SF).withColumn("image_id", F.col("image_id").cast("string")) \
        .withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    tags = tags_view(spark, SF).withColumn("image_id", F.col("image_id").cast("string"))
    picks = picks_view(spark, SF).withColumn("image_id", F.col("image_id").cast("string"))
    paths = {n: os.path.join(tmp_dir, n) for n in ("images", "tags", "picks")}
    images.write.json(paths["images"])
    # nested tag feed: one line per tag row plus a malformed and a bad line
    tags.select("image_id", F.array(F.struct("tag", "version", "probability")).alias("tags")) \
        .write.json(paths["tags"])
    with open(os.path.join(paths["tags"], "extra.json"), "w") as f:
        f.write('{"image_id": "x", "tags": [\n{"image_id": "y", "tags": "none"}\n')
    picks.select(F.struct("hotel_id").alias("key"), F.struct("image_id", "cdn_url").alias("value")) \
        .write.json(paths["picks"])
    return paths, images, tags, picks


def test_job_matches_table_plan(spark, tmp_dir):
    paths, images, tags, picks = write_feeds(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    res = run_job(spark, paths["images"], paths["tags"], paths["picks"], out, POLICY)
    ref = select_and_reconcile(images, tags, picks, POLICY)
    snap = sorted((r.hotel_id, r.image_id, r.image_score) for r in spark.read.json(res.outputs["snapshot"]).collect())
    want = sorted((r.hotel_id, r.image_id, r.image_score) for r in ref.snapshot.collect())
    assert snap == want
    kv = spark.read.json(res.outputs["updated_main_images"])
    assert kv.count() == picks.count()
    feed = spark.read.json(res.outputs["cdc"])
    applied = sorted(tuple(r) for r in outputs.apply_cdc(picks.select("hotel_id", "image_id"), feed).collect())
    assert applied == sorted((h, i) for h, i, _ in snap)
    m = {r.metric: r.value for r in spark.read.json(res.outputs["metrics"]).collect()}
    assert m["image_tags_rejected"] == 2 and m["images_rejected"] == 0
    assert m["snapshot_rows"] == len(snap)
    reasons = sorted(r.reasons for r in spark.read.json(res.outputs["rejected_image_tags"]).collect())
    assert reasons == ["$:malformed", "tags:type"]


def test_gate_and_split(spark, tmp_dir):
    from curato.plans.job import split_feeds, validation_gate
    from curato.sources import contracts
    paths, images, tags, picks = write_feeds(spark, tmp_dir)
    gate = {(r.feed, r.metric): r.value for r in validation_gate(spark, {
        "images": (paths["images"], contracts.IMAGE_CONTRACT),
        "image_tags": (paths["tags"], contracts.TAGS_CONTRACT)}).collect()}
    assert gate[("image_tags", "image_tags_rejected")] == 2
    assert gate[("images", "images_valid")] == images.count()
    with pytest.raises(ValueError):
        validation_gate(spark, {"image_tags": (paths["tags"], contracts.TAGS_CONTRACT)}, fail_on_reject=True)
    out = split_feeds(spark, paths["images"], paths["tags"], "images", 3, os.path.join(tmp_dir, "chunks"))
    back = read_chunk_dir(spark, out["images"], IMAGES_SCHEMA)
    sizes = sorted(r["count"] for r in back.groupBy("chunk_id").count().collect())
    n = images.count()
    size = -(-n // 3)
    assert len(sizes) == 3 and sum(sizes) == n and max(sizes) == size
    # The chunks hold the input's lines, unchanged.
    lines = sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(out["images"]).collect())
    assert lines == sorted(r.value for r in spark.read.text(paths["images"]).collect())
    assert back.filter("width is not null").count() == images.filter("width is not null").count()


def test_job_takes_a_json_schema_and_leaves_nothing_behind(spark, tmp_dir):
    from curato.session import ensure_checkpoint_dir
    paths, images, _, _ = write_feeds(spark, tmp_dir)
    schema = {"type": "object", "required": ["image_id"], "properties": {
        "image_id": {"type": "string"}, "hotel_id": {"type": "integer", "maximum": 20}}}
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    picks_before = before
    res = run_job(spark, paths["images"], paths["tags"], paths["picks"], os.path.join(tmp_dir, "out2"), POLICY,
                  feed_contracts={"images": schema})
    m = {r.metric: r.value for r in spark.read.json(res.outputs["metrics"]).collect()}
    assert m["images_valid"] == images.filter("hotel_id <= 20").count() and m["images_rejected"] > 0
    reasons = {r.reasons for r in spark.read.json(res.rejected["images"]).collect()}
    assert reasons == {"hotel_id:maximum"}
    assert set(os.listdir(tables)) == picks_before
    with pytest.raises(ValueError):
        run_job(spark, paths["images"], paths["tags"], paths["picks"], tmp_dir, POLICY, feed_contracts={"x": schema})
    assert set(os.listdir(tables)) == picks_before


def test_cli_runs_the_job(spark, tmp_dir):
    import subprocess
    import sys
    paths, _, _, picks = write_feeds(spark, tmp_dir)
    out = os.path.join(tmp_dir, "cli-out")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-m", "curato.plans.job", "--images", paths["images"],
                          "--tags", paths["tags"], "--main_images", paths["picks"], "--out", out,
                          "--as_of", "2006-01-01"],
                         capture_output=True, text=True, timeout=900, cwd=root)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "snapshot:" in res.stdout
    from curato.sources.commits import read_output
    assert read_output(spark, out, "updated_main_images").count() == picks.count()
    metrics = {r.metric: r.value for r in read_output(spark, out, "metrics").collect()}
    assert metrics["image_tags_rejected"] == 2


def test_a_failed_run_leaves_the_earlier_outputs(spark, tmp_dir, monkeypatch):
    from curato.plans import job
    from curato.sources import commits
    paths, _, _, picks = write_feeds(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out3")
    assert commits.current(spark, out) == {}
    with pytest.raises(ValueError):
        commits.read_output(spark, out, "snapshot")
    run_job(spark, paths["images"], paths["tags"], paths["picks"], out, POLICY)
    first = commits.current(spark, out)
    held = sorted(tuple(r) for r in commits.read_output(spark, out, "snapshot").collect())
    writes, real = [], job.sinks.write_jsonl

    def breaks(df, path, *a, **kw):      # between two outputs
        writes.append(path)
        if len(writes) == 2:
            raise OSError("no space left")
        real(df, path, *a, **kw)

    monkeypatch.setattr(job.sinks, "write_jsonl", breaks)
    with pytest.raises(OSError):
        run_job(spark, paths["images"], paths["tags"], paths["picks"], out, POLICY)
    assert commits.current(spark, out) == first and len(os.listdir(os.path.join(out, "runs"))) == 1
    assert sorted(tuple(r) for r in commits.read_output(spark, out, "snapshot").collect()) == held
    monkeypatch.undo()
    # Later runs replace it at once; the one before stays for its readers, older ones go.
    for _ in range(2):
        before = commits.current(spark, out)
        run_job(spark, paths["images"], paths["tags"], paths["picks"], out, POLICY)
        assert commits.current(spark, out) != before and set(commits.current(spark, out)) == set(before)
        assert os.path.isdir(before["snapshot"])
    assert not os.path.isdir(first["snapshot"]) and len(os.listdir(os.path.join(out, "runs"))) == 2
    with pytest.raises(ValueError):
        commits.Commit(spark, out, keep=0)
