"""Scans with inferred types, and the fold of a file with every chunk."""

import itertools
import os

import pytest

from curato.operators import chunking
from curato.policy import Policy
from curato.sources.feeds import infer_scan


def write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return os.path.join(folder, name)


def test_types_are_merged_over_all_lines(spark, tmp_dir):
    write(tmp_dir, "a.jsonl", ['{"i":1,"f":1,"n":null,"c":1,"o":{"x":1,"y":"t"},"l":[1,2],"m":[{"p":1},{"p":"x"}]}', "", "[1]"])
    write(tmp_dir, "b.jsonl", ['{"i":2,"f":1.5,"c":"x","o":{"x":2.5,"z":true},"l":[],"odd name`":3,"it\'s":"q"}', "{"])
    write(tmp_dir, "c.jsonl", ['{"big":123456789012345678901,"c":{"k":1},"m":[{"p":true}],"o":null}'])
    got = infer_scan(spark, tmp_dir)
    assert got.schema.simpleString() == (
        "struct<big:double,c:string,f:double,i:bigint,it's:string,l:array<bigint>,m:array<struct<p:string>>,n:string,"
        "o:struct<x:double,y:string,z:boolean>,odd name`:bigint>")
    rows = {r["i"]: r.asDict(recursive=True) for r in got.rows.collect()}
    assert rows[1]["c"] == "1" and rows[1]["m"] == [{"p": "1"}, {"p": "x"}] and rows[1]["f"] == 1.0
    assert rows[2]["o"] == {"x": 2.5, "y": None, "z": True} and rows[2]["odd name`"] == 3 and rows[2]["it's"] == "q"
    assert rows[None]["c"] == '{"k":1}' and rows[None]["o"] is None and rows[None]["big"] == 123456789012345678901.0
    assert {tuple(r) for r in got.conflicts.collect()} == {
        ("$.c", "BIGINT", 1), ("$.c", "STRING", 1), ("$.c", "OBJECT", 1),
        ("$.m[].p", "BIGINT", 1), ("$.m[].p", "STRING", 1), ("$.m[].p", "BOOLEAN", 1)}
    assert sorted(r.value for r in got.malformed.collect()) == ["[1]", "{"]


def test_an_empty_input_gives_an_empty_relation(spark, tmp_dir):
    got = infer_scan(spark, write(tmp_dir, "a.txt", [""]))
    assert got.rows.columns == [] and got.rows.count() == 0 and got.conflicts.collect() == []
    only = infer_scan(spark, write(tmp_dir, "b.txt", ["5", '"x"']))
    assert only.rows.columns == [] and only.malformed.count() == 2


def fold(spark, df_rows, chunk_rows, **kw):
    df = spark.createDataFrame(df_rows, "k long, a string")
    chunks = spark.createDataFrame(chunk_rows, "k long, chunk_id int, p string")
    out = chunking.fold_chunks(df, chunks, "k", **kw)
    return out.columns, sorted(tuple(r) for r in out.collect())


def brute(df_rows, chunk_rows):
    ids = sorted({c for _, c, _ in chunk_rows if c is not None})
    out = []
    for k, a in df_rows:
        if not ids:
            out.append((k, a))
        elif k is not None:
            sides = [[p for kk, c, p in chunk_rows if kk == k and c == i] for i in ids]
            out += [(k, a, *combo) for combo in itertools.product(*sides)]
    return sorted(out)


@pytest.mark.parametrize("hot_rows", [100_000, 5])
def test_fold_equals_one_join_after_another(spark, hot_rows):
    df = [(i % 7, f"a{i}") for i in range(20)] + [(None, "null"), (99, "alone")]
    chunks = [(i % 9, i % 4 + 1, f"p{i}") for i in range(40)]
    chunks += [(3, 2, f"hot{i}") for i in range(60)] + [(None, 1, "null"), (3, None, "no chunk"), (3, 2, "same"), (3, 2, "same")]
    columns, got = fold(spark, df, chunks, hot_rows=hot_rows)
    assert columns == ["k", "a", "p_1", "p_2", "p_3", "p_4"]
    assert got == brute(df, chunks) and len(got) > 100


def test_fold_splits_a_hot_key_of_the_file_too(spark):
    df = [(1, f"a{i}") for i in range(50)] + [(2, "b")]
    chunks = [(1, 1, "x"), (1, 2, "y"), (1, 2, "z"), (2, 1, "w"), (2, 2, "v")]
    assert fold(spark, df, chunks, hot_rows=4)[1] == brute(df, chunks)


def test_fold_without_chunks(spark):
    columns, got = fold(spark, [(1, "a")], [])
    assert columns == ["k", "a"] and got == [(1, "a")]


def test_null_as_zero_belongs_to_scorer_a():
    with pytest.raises(ValueError):
        Policy(variant="B", null_as_zero=True)
