"""The registered training-data queries against DuckDB, and the pipeline."""

import os

import duckdb
import pytest
from helpers import empty_like
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from curato.llm import exact_dedup, near_dedup, quality_classifier, source_mix
from curato.llm.catalog import ORACLE, QUERIES
from curato.llm.common import table
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_registered_once_per_operator():
    names = [k.split("_")[0] for k in QUERIES]
    assert sorted(names) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert canon(got.column_names, [tuple(r.values()) for r in got.to_pylist()]) == canon(
        want.column_names, [tuple(r.values()) for r in want.to_pylist()])


def test_pipeline_stages_decide_as_their_operators(spark):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, None
    labels = table(spark, SF, "labels")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).collect()
        got = sorted(r.doc_id for r in out)
        before = sorted(r.doc_id for r in docs.collect())
        if name == "quality":
            net = quality_classifier.learn(quality_classifier.fit_sample(docs, labels, "quality", quality_classifier.SAMPLE))
            want = [r.doc_id for r in quality_classifier.score_documents(docs, net).collect() if r.predicted]
        elif name == "exact_dedup":
            want = [r.doc_id for r in exact_dedup.find_copies(docs).collect() if r.kept]
        elif name == "near_dedup":
            want = [r.doc_id for r in near_dedup.near_classes(docs).collect() if r.kept]
        else:
            want = [r.doc_id for r in source_mix.mix_plan(docs, source_mix.PIPELINE).collect() for _ in range(r.copies)]
        assert got == sorted(want) and set(got) <= set(before)
        docs = spark.createDataFrame(out, docs.schema)
        assert docs.columns == columns
        ids = got
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in last) == ids and all(len(r.ids) == r.n_tokens for r in last)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == ids


def test_stages_take_empty_tables(spark):
    docs = empty_like(table(spark, SF, "documents"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_takes_odd_documents_and_keeps_one_table(spark, tmp_path, monkeypatch):
    from curato.session import ensure_checkpoint_dir, table_scope
    from helpers import odd_documents, with_clashes
    extra = with_clashes(odd_documents(spark), "row", "user", "__row", "copies", "norm")
    table(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    extra.unionByName(table(spark, SF, "documents").withColumns({c: F.lit("x") for c in (
        "row", "user", "__row", "copies", "norm")})).write.parquet(str(tmp_path / "documents.parquet"))
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    os.makedirs(tables, exist_ok=True)
    before = set(os.listdir(tables))
    with table_scope(spark):
        out = corpus_pipeline.run(spark, str(tmp_path))
        rows = out.collect()
        left = set(os.listdir(tables)) - before
        assert len(left) == 1 and next(iter(left)).startswith("stage_mix-")
    assert set(os.listdir(tables)) == before
    assert len(rows) > 50 and all(len(r.ids) == r.n_tokens for r in rows)
    assert len({r.ids_sha256 for r in rows if r.n_tokens > 2}) == len([r for r in rows if r.n_tokens > 2])
