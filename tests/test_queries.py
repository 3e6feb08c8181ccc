"""Every registered query against its DuckDB statement, on the smallest tables,
plus plan properties that must hold at any scale."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from curato.catalog import QUERIES
from curato.oracle import ORACLE
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    table = QUERIES[name](spark, SF).toArrow()
    expected = duck.sql(ORACLE[name]).to_arrow_table()
    assert ({f.name: str(f.type) for f in table.schema}
            == {f.name: str(f.type) for f in expected.schema})
    s_cols, s_rows = canon(table.column_names, [tuple(r.values()) for r in table.to_pylist()])
    d_cols, d_rows = canon(expected.column_names, [tuple(r.values()) for r in expected.to_pylist()])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["hotel_id", "image_id", "image_score", "cdn_url"]
    assert df.count() > 0


PLAN_QUERIES = ["best_tag", "top_in_group", "rank_in_group", "old_new_scores", "cdc", "contract_rejected",
                "assign_chunks", "join_counts"]


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["best_tag"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "l_orderkey" in read and "l_extendedprice" not in read and "l_shipdate" not in read


def test_top_pick_uses_group_limit(spark):
    plan = QUERIES["top_in_group"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_single_partition_window_over_rows(spark):
    """Full ranking must not gather a whole group (or everything) in one task."""
    plan = QUERIES["rank_in_group"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_fan_out_left_join_has_no_outer_join(spark):
    """A hot key on the right of a left outer join cannot be split by AQE;
    the enrich join is planned as inner + anti instead."""
    plan = QUERIES["enrich_left"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_full_outer_joins(spark, name):
    """No query pairs rows without a key, and none uses a full outer join
    (whose skewed partitions adaptive execution cannot split)."""
    qe = QUERIES[name](spark, SF)._jdf.queryExecution()
    plan = qe.optimizedPlan().toString()
    assert "Cross" not in plan and "FullOuter" not in plan
    physical = qe.executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def _segments(spark, name):
    from curato import session
    session.STAGED_PLANS = []
    try:
        result = QUERIES[name](spark, SF)
        return [*session.STAGED_PLANS, ("result", result._jdf.queryExecution().executedPlan().toString())]
    finally:
        session.STAGED_PLANS = None


def test_staged_relations_hold_only_what_is_read(spark):
    """The scored images are projected before they are written."""
    from curato.catalog import _selection
    from curato.plans.selection import STAGED_COLUMNS
    sel = _selection(spark, SF)[0]
    assert tuple(sel.scored_all.columns) == STAGED_COLUMNS
    read = set(sel.updated_picks.columns) | set(sel.cdc.columns) | set(sel.status.columns)
    assert {"image_id", "hotel_id", "is_active", "cdn_url"} <= read
    for name, fields in (("rank_in_group", "struct<hotel_id:bigint,image_id:bigint,image_score:double,__group:struct<hotel_id:bigint>>"),
                         ("assign_chunks", "struct<o_orderkey:bigint,__seq:bigint>")):
        assert fields in dict(_segments(spark, name))["result"]


def test_outputs_read_each_staged_table_at_most_twice(spark):
    segments = _segments(spark, "metrics")
    result = segments[-1][1]
    assert [t for t, _ in segments[:-1]].count("status") == 1
    assert 0 < result.count("FileScan") <= 5          # status twice, best picks once, scored images once
    counts = _segments(spark, "join_counts")[-1][1]
    assert counts.count("l_orderkey") > 0 and len([x for x in counts.split("FileScan") if "lineitem.parquet" in x]) == 1
    assert all("lineitem" not in plan for _, plan in _segments(spark, "deleted_picks"))


def test_each_row_moves_once_when_it_is_numbered(spark):
    """Chunk numbers need one range exchange; ranks one exchange by group, and the
    rows of a hot group one range exchange."""
    segments = dict(_segments(spark, "assign_chunks"))
    assert segments["numbered"].count("Exchange rangepartitioning") == 1
    assert segments["result"].count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in segments["result"]
    rows = [x for x in segments["result"].split("\n") if "Exchange hashpartitioning" in x]
    assert len(rows) == 1                                                # the counts of the partitions
    segments = dict(_segments(spark, "rank_in_group"))
    assert segments["result"].count("Exchange hashpartitioning") == 1 and "ranged" not in segments
    from pyspark.sql import functions as F

    from curato import session
    from curato.operators.ranking import rank_in_group
    hot = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), "id")
    session.STAGED_PLANS = []
    try:
        ranked = rank_in_group(hot, ["g"], [F.col("id").asc()])
        segments = [*session.STAGED_PLANS, ("result", ranked._jdf.queryExecution().executedPlan().toString())]
    finally:
        session.STAGED_PLANS = None
    segments = dict(segments)
    assert segments["ranged"].count("Exchange rangepartitioning") == 1 and "SortMergeJoin" not in segments["result"]


@pytest.mark.parametrize("name", ["metrics", "assign_chunks", "rank_in_group", "contract_recursive", "line_numbers",
                                  "join_chunks_fold", "inferred_scan", "split_sides", "key_value", "chunk_roundtrip"])
def test_a_scope_leaves_no_table(spark, name):
    from curato.session import ensure_checkpoint_dir, table_scope
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    os.makedirs(tables, exist_ok=True)
    before = set(os.listdir(tables))
    with table_scope(spark) as made:
        assert QUERIES[name](spark, SF).count() > 0
        assert made and set(os.listdir(tables)) > before
    assert set(os.listdir(tables)) == before
