import random

from pyspark.sql import functions as F

from curato.operators.chunking import assign_chunks, join_chunks
from curato.operators.ranking import best_tag, dedupe_images, rank_in_group, top_in_group


def test_best_tag_tie_breakers(spark):
    tags = spark.createDataFrame(
        [(1, "b", "1", 0.9), (1, "a", "2", 0.9), (1, "a", "1", 0.9), (1, "z", "1", None),
         (2, "x", "1", None), (2, "y", "1", None), (3, "q", "1", 0.1)],
        "image_id long, tag string, version string, probability double")
    got = {r.image_id: (r.tag, r.version, r.probability) for r in best_tag(tags).collect()}
    assert got == {1: ("a", "1", 0.9), 2: ("x", "1", None), 3: ("q", "1", 0.1)}


def test_dedupe_images_keeps_newest(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1), "b"), (1, dt.datetime(2021, 1, 1), "c"), (1, dt.datetime(2021, 1, 1), "a"),
         (2, None, "x")], "image_id long, created_at timestamp, cdn_url string")
    got = {r.image_id: r.cdn_url for r in dedupe_images(df).collect()}
    assert got == {1: "a", 2: "x"}


def _brute_ranks(rows):
    by_group = {}
    for g, score, i in rows:
        by_group.setdefault(g, []).append((-score, i))
    out = {}
    for g, items in by_group.items():
        for pos, (_, i) in enumerate(sorted(items), start=1):
            out[i] = (pos, len(items))
    return out


def test_rank_in_group_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if i % 2 == 0 else rnd.randint(1, 60)   # group 0 holds half of all rows
        if i % 97 == 0:
            g = None
        rows.append((g, float(rnd.randint(0, 50)), i))
    df = spark.createDataFrame(rows, "g long, score double, id long")
    ranked = rank_in_group(df, ["g"], [F.col("score").desc(), F.col("id").asc()],
                           rank_col="rank", size_col="n", num_partitions=7)
    got = {r.id: (r.rank, r.n) for r in ranked.collect()}
    assert got == _brute_ranks(rows)


def test_rank_in_group_single_partition_and_empty(spark):
    df = spark.createDataFrame([(1, 1.0, 1), (1, 2.0, 2)], "g long, score double, id long")
    got = {r.id: r.rank for r in rank_in_group(df, ["g"], [F.col("score").desc(), F.col("id")],
                                               num_partitions=1).collect()}
    assert got == {2: 1, 1: 2}
    empty = df.limit(0)
    assert rank_in_group(empty, ["g"], [F.col("id")]).count() == 0


def test_top_in_group_plan_has_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    plan = top_in_group(df, ["g"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_assign_chunks_sizes(spark):
    df = spark.range(9).withColumnRenamed("id", "k")
    got = [r.chunk_id for r in assign_chunks(df, 6, [F.col("k")]).orderBy("k").collect()]
    assert got == [1, 1, 2, 2, 3, 3, 4, 4, 5]        # ceil(9/6) = 2 -> 5 chunks
    big = spark.range(15000).withColumnRenamed("id", "k")
    counts = {r.chunk_id: r["count"] for r in assign_chunks(big, 7, [F.col("k")]).groupBy("chunk_id").count().collect()}
    assert sum(counts.values()) == 15000
    assert sorted(counts.values()) == [2142] + [2143] * 6


def test_assign_chunks_rejects_zero(spark):
    import pytest
    with pytest.raises(ValueError):
        assign_chunks(spark.range(3), 0, [F.col("id")])


def test_join_chunks_modes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "image_id long, v string")
    chunks = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (3, 2)], "image_id long, chunk_id int")
    union = sorted((r.image_id, r.chunk_id) for r in join_chunks(left, chunks, "image_id").collect())
    assert union == [(1, 1), (1, 2), (2, 1), (3, 2)]
    everywhere = [r.image_id for r in join_chunks(left, chunks, "image_id", mode="all").collect()]
    assert everywhere == [1]


def test_join_against_chunk_directory(spark, tmp_dir):
    import os
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from curato.sources.feeds import read_chunk_dir
    d = os.path.join(tmp_dir, "tag_chunks")
    os.makedirs(d)
    for i, rows in enumerate([['{"image_id":1,"tag":"a"}', '{"image_id":2,"tag":"b"}'],
                              ['{"image_id":1,"tag":"c"}', '{"image_id":3,"tag":"d"}']], start=1):
        with open(os.path.join(d, f"chunk_{i}.jsonl"), "w") as f:
            f.write("\n".join(rows) + "\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write('{"image_id":1,"tag":"zzz"}\n')
    schema = StructType([StructField("image_id", LongType()), StructField("tag", StringType())])
    chunks = read_chunk_dir(spark, d, schema)
    left = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "image_id long, v string")
    union = sorted((r.image_id, r.tag, r.chunk_id) for r in join_chunks(left, chunks, "image_id").collect())
    assert union == [(1, "a", "chunk_1.jsonl"), (1, "c", "chunk_2.jsonl"), (2, "b", "chunk_1.jsonl")]
    assert [r.image_id for r in join_chunks(left, chunks, "image_id", mode="all").collect()] == [1]


def test_rank_in_group_multi_column_groups(spark):
    rows = [(a, b, float(i % 7), i) for i, (a, b) in enumerate(
        [(1, "x")] * 40 + [(1, "y")] * 5 + [(2, None)] * 9 + [(None, None)] * 3)]
    df = spark.createDataFrame(rows, "a long, b string, score double, id long")
    got = {r.id: (r.rank, r.n) for r in rank_in_group(
        df, ["a", "b"], [F.col("score").desc(), F.col("id")], size_col="n", num_partitions=5).collect()}
    want = {}
    groups = {}
    for a, b, s, i in rows:
        groups.setdefault((a, b), []).append((-s, i))
    for members in groups.values():
        for pos, (_, i) in enumerate(sorted(members), start=1):
            want[i] = (pos, len(members))
    assert got == want
