import math
import random

import pytest
from helpers import with_clashes
from pyspark.sql import functions as F

from curato.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, n_pos=H.N_POS, n_neg=H.N_NEG, step=50):
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (int(math.fmod(label + 1, 10)) if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        ok[i] = min(ok.get(i, row), row)
    out = set()
    for a, (label, v) in ok.items():
        if a % step:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in ok.items() if i != a}
        first = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in first if ok[i][0] == label][:n_pos]:
            fit = [i for i in first if ok[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out |= {(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fit[:n_neg])}
    return out


def mined(df, **kw):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = [tuple(r) for r in H.mine(H.quantised(df, label), F.col("id") % 50 == 0, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(rng, n, d=4):
    return [(i, [rng.choice([-0.5, 0.1, 0.25, 0.5, 1.0, rng.random()]) for _ in range(d)], rng.randrange(4)) for i in range(n)]


def f32(rows):
    import numpy as np
    return [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("blocks", [(8192, 4096), (37, 4)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(H, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(H, "ANCHOR_BLOCK", blocks[1])
    blocks[1] < 5 and monkeypatch.setattr(H, "AT_ONCE", 2)
    rows = f32(vectors(random.Random(1), 400))
    got = mined(table(spark, rows))
    assert got == brute(rows) and len(got) > 30


def test_one_vector_and_one_label_hold_many_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "ROW_BLOCK", 50)
    rng = random.Random(2)
    rows = f32([(i, [0.5, 0.5, 0.25, 0.1] if i % 3 else v, 1 if i % 2 else label) for i, v, label in vectors(rng, 300)])
    got = mined(table(spark, rows))
    assert got == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = f32(vectors(rng, 150))
    rows += [(None, [1.0] * 4, 1), (1000, None, 1), (1001, [1.0, None, 1.0, 1.0], 1), (1002, [float("nan")] * 4, 1),
             (1003, [float("inf"), 0.0, 0.0, 0.0], 1), (1050, [1.0] * 4, None), (1004, [], 2), (1005, [0.5], 2),
             (1006, [0.5] * 9, 3), (-50, [0.5] * 4, 0), (-1, [0.75] * 4, 0), (1100, [0.0] * 4, 1), (5, [0.5] * 4, 3), (5, [0.5] * 4, 3)]
    got = mined(with_clashes(table(spark, rows), "id", "score", "kind", "row_block", "anchor_id"))
    assert got == brute(rows)


def test_zero_scores_keep_positives_before_negatives(spark):
    # All scores 0: every other label's row is in the window, also those with smaller ids than the positive.
    rows = [(i, [0.0, 0.0], i % 2) for i in range(8)] + [(50, [1.0, 1.0], 1)]
    assert mined(table(spark, rows)) == brute(rows) != set()


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), 1.0], i % 2) for i in range(60)]
    assert mined(table(spark, rows)) == brute(rows)


def test_huge_components_do_not_fail(spark):
    rows = [(i, [3.0e38, -3.0e38, 1.0e17], i % 2) for i in range(60)] + [(100 + i, [2.0 ** 23, 2.0 ** 23 - i], i % 2) for i in range(40)]
    mined(table(spark, rows))


def test_empty_and_without_positives(spark):
    assert mined(table(spark, [])) == set()
    assert mined(table(spark, [(50, [1.0], 1), (51, [1.0], 2)])) == set()
    assert mined(table(spark, [(1, [1.0], 1), (2, [1.0], 1)])) == set()


def test_sorted_stream_gathers_no_anchor(spark):
    rows = f32(vectors(random.Random(4), 120))
    label = F.col("label")
    plan = H.mine(H.quantised(table(spark, rows), label), F.col("id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Sort [anchor_id" in plan and "CartesianProduct" not in plan
