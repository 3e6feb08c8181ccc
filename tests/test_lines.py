"""Line numbers and chunks in file order, and where rejected lines are."""

import glob as files
import os

import pytest
from pyspark.sql import functions as F

from curato.operators import chunking, validate
from curato.plans.job import load_feed, located_rejects, split_feeds
from curato.sources import sinks
from curato.sources.feeds import number_lines


def write(folder, name, lines, end="\n"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write("\n".join(lines) + (end if lines else ""))


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


FILES = {"a.jsonl": [f"a line {i} " + "x" * (i % 50) for i in range(200)], "b.jsonl": ["", "  ", "b"], "c.jsonl": [],
         "d.jsonl": ["é" * 700, "", "short"], "e.jsonl": [str(i) for i in range(300)]}


def test_numbers_over_files_of_several_splits(spark, tmp_dir, small_splits):
    for name, lines in FILES.items():
        write(tmp_dir, name, lines, "" if name == "e.jsonl" else "\n")
    tables = []
    got = number_lines(spark, tmp_dir, "*.jsonl", tables)
    rows = sorted((os.path.basename(r.file), r.line, r.position, r.value) for r in got.collect())
    want, position = [], 0
    for name in sorted(FILES):
        for i, text in enumerate(FILES[name]):
            want.append((name, i + 1, position, text))
            position += 1
    assert rows == want
    blocks = spark.read.parquet(tables[1])
    assert blocks.filter(F.col("file").endswith("a.jsonl")).count() > 10     # one file, many splits
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort " not in plan               # no line moves


def test_numbers_do_not_depend_on_the_join(spark, tmp_dir, small_splits, monkeypatch):
    from curato.sources import feeds
    write(tmp_dir, "a.txt", FILES["a.jsonl"])
    monkeypatch.setattr(feeds, "MAX_SPLITS", 0)
    assert sorted((r.line, r.value) for r in number_lines(spark, tmp_dir).collect()) == list(enumerate(FILES["a.jsonl"], 1))


def test_small_splits_share_tasks_and_end_with_the_read(spark, tmp_dir):
    names = [f"{k}.jsonl" for k in range(6)]
    for name in names:
        write(tmp_dir, name, FILES["a.jsonl"])
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum")
    before, tables = [spark.conf.get(n, None) for n in settings], []
    got = number_lines(spark, tmp_dir, "*.jsonl", tables, split_size="300")
    assert sorted((os.path.basename(r.file), r.line, r.position, r.value) for r in got.collect()) == [
        (name, i + 1, 200 * k + i, text) for k, name in enumerate(names) for i, text in enumerate(FILES["a.jsonl"])]
    splits = spark.read.parquet(tables[1]).groupBy("file").count().collect()
    assert len(splits) == 6 and all(r["count"] > 10 for r in splits)
    assert len(files.glob(f"{tables[0].removeprefix('file:')}/part-*")) <= 6         # a file a task
    assert [spark.conf.get(n, None) for n in settings] == before


@pytest.mark.parametrize("name", ["line_numbers", "chunks_in_file_order", "violation_report", "split_sides"])
def test_queries_over_small_splits_run_few_tasks(spark, name):
    from curato.catalog import QUERIES
    sc = spark.sparkContext
    sc.setJobGroup(f"tasks of {name}", name)
    try:
        assert QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"tasks of {name}")]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [sc.statusTracker().getStageInfo(i) for j in jobs for i in j.stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 16        # a task for each split would be 60 and more


def test_chunks_hold_slices_in_file_order(spark, tmp_dir, small_splits):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    for name, lines in FILES.items():
        write(src, name, lines)
    every = [x for name in sorted(FILES) for x in FILES[name]]
    for n in (1, 3, 7, 1000):
        target = os.path.join(out, str(n))
        sinks.write_file_chunks(number_lines(spark, src), n, target)
        size = -(-len(every) // n)
        want = [every[i:i + size] for i in range(0, len(every), size)]
        got = []
        for k in range(1, len(want) + 1):
            text = "".join(open(p).read() for p in sorted(files.glob(f"{target}/chunk_id={k}/part-*")))
            got.append(text.split("\n")[:-1])
        assert got == want
    with pytest.raises(ValueError):
        chunking.chunks_by_position(number_lines(spark, src), 0)
    assert chunking.chunks_by_position(number_lines(spark, os.path.join(src, "c.jsonl")), 3).collect() == []


def test_split_feeds_keeps_the_input_order_and_no_table(spark, tmp_dir, small_splits):
    from curato.session import ensure_checkpoint_dir
    write(os.path.join(tmp_dir, "images"), "i.jsonl", FILES["a.jsonl"])
    write(os.path.join(tmp_dir, "tags"), "t.jsonl", FILES["e.jsonl"])
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    os.makedirs(tables, exist_ok=True)
    before = set(os.listdir(tables))
    out = split_feeds(spark, os.path.join(tmp_dir, "images"), os.path.join(tmp_dir, "tags"), "both", 4, os.path.join(tmp_dir, "out"))
    assert set(out) == {"images", "tags"} and set(os.listdir(tables)) == before
    first = "".join(open(p).read() for p in sorted(files.glob(f"{out['tags']}/chunk_id=1/part-*")))
    assert first.split("\n")[:-1] == FILES["e.jsonl"][:75]
    assert split_feeds(spark, "x", "y", None, 4, tmp_dir) == {}
    with pytest.raises(ValueError):
        split_feeds(spark, "x", "y", "neither", 4, tmp_dir)


def test_rejected_lines_say_where_they_are(spark, tmp_dir, small_splits):
    good = '{"image_id":"i%d","hotel_id":%d,"width":5}'
    lines = [good % (i, i) for i in range(60)]
    lines[3], lines[10], lines[41], lines[59] = "", '{"image_id":7}', "{", good % (59, 59) + "}"
    lines[20] = '{"image_id":"i20","hotel_id":1,"hotel_id":20}'
    write(tmp_dir, "x.jsonl", lines)
    table, valid, _ = load_feed(spark, tmp_dir, "images")
    bad = located_rejects(table)
    assert {r.line: r.reasons for r in bad.collect()} == {
        11: "image_id:type;hotel_id:required", 21: "$:malformed", 42: "$:malformed", 60: "$:malformed"}
    report = {(r.line, r.path, r.rule, r.found) for r in validate.violation_report(bad, "file", "line").collect()}
    assert {(11, "image_id", "type", "7"), (11, "hotel_id", "required", None), (42, "$", "malformed", "{")} <= report
    assert valid.count() == 55
    table, valid, _ = load_feed(spark, tmp_dir, "images", repeated="last")
    assert valid.filter("image_id = 'i20'").first()["hotel_id"] == 20 and located_rejects(table).count() == 3
