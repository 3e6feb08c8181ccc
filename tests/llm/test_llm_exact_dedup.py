import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, empty_like, odd_documents, with_clashes

from curato.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((doc_id is None, doc_id, i))
    out = []
    for text, own in groups.items():
        own.sort(key=lambda x: (x[0], x[1] if x[1] is not None else 0, x[2]))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, own[0][1], len(own), k == 0, sha) for k, (_, d, _) in enumerate(own)]
    return sorted(out, key=str)


def result(df):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 30000])
def test_filter_holds_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 60, n, dtype=np.uint64)
    built = X.build_filter(keys)
    assert X.in_filter(built, keys).all()
    others = rng.integers(0, 1 << 60, 20000, dtype=np.uint64)
    assert X.in_filter(built, others).mean() < 0.02
    if n >= 1000:
        assert len(built[3]) < 1.5 * len(np.unique(keys))


def test_matches_brute_force_on_odd_rows(spark):
    df = odd_documents(spark)
    assert result(X.find_copies(df)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_copies_within_and_across_arrivals(spark):
    rows = [(i, f"text {i % 37}" + " " * (i % 3 + 1) + "end") for i in range(400)]
    assert result(X.find_copies(documents(spark, rows))) == brute(rows)


def test_screened_digest_needs_equal_bytes(spark):
    """A digest that meets a bucket but whose bytes differ is no copy."""
    rows = spark.createDataFrame([(1, 1, "d", "old text"), (2, 2, "d", "new text"), (3, 3, "e", "same"), (4, 4, "e", "same")],
                                 "row_id long, doc_id long, sha string, norm string")
    old, new = (X.group_arrival(rows.filter(f"row_id in {ids}")) for ids in ("(1, 3)", "(2, 4)"))
    same = X.confirm(rows.select("sha").distinct(), new, old, rows)
    assert [r.sha for r in same.collect()] == ["e"]


def test_hot_text_is_one_row_before_the_shuffle(spark):
    rows = [(i, "hot") for i in range(500)] + [(1000 + i, f"cold {i}") for i in range(300)]
    got = result(X.find_copies(documents(spark, rows).repartition(7)))
    assert got == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = odd_documents(spark)
    assert X.find_copies(empty_like(df)).count() == 0
    extra = with_clashes(df, "keep_id", "sha", "row_id", "norm", "batch", "kept")
    assert result(X.find_copies(extra)) == result(X.find_copies(df))
    extra = with_clashes(extra, "row", "user", "__row", "__sha")
    staged = X.dedup_stage(extra)
    assert staged.filter("row = 'extra' and user = 'extra' and __row = 'extra' and __sha = 'extra'").count() == staged.count()
    assert staged.columns == extra.columns
    assert staged.count() == sum(r[3] for r in result(X.find_copies(df)))
    assert X.dedup_stage(empty_like(extra)).count() == 0
