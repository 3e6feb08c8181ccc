import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, empty_like, odd_documents, with_clashes

from curato.llm import dart_minhash as D
from curato.llm import near_dedup as N
from curato.llm.common import mix64


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """Class (as the smallest id) of every (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    out = []
    for own in groups.values():
        ids = [d for d in own if d is not None]
        out += [(d, min(ids) if ids else None, len(own)) for d in own]
    return sorted(out, key=str)


def classes(df):
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in df.collect()), key=str)


@pytest.mark.parametrize("shared", [0.2, 0.9])
def test_signatures_estimate_weighted_jaccard(shared):
    rng = np.random.default_rng(3)
    a = {i: float(rng.uniform(0.05, 7)) for i in range(80)}
    b = {i: a[i] if i in a and rng.random() < shared else float(rng.uniform(0.05, 7)) for i in range(10, 90)}
    keys = set(a) | set(b)
    true = sum(min(a.get(i, 0), b.get(i, 0)) for i in keys) / sum(max(a.get(i, 0), b.get(i, 0)) for i in keys)
    owner = np.array([0] * len(a) + [1] * len(b))
    element = mix64(np.array(list(a) + list(b), dtype=np.uint64), 77)
    got = []
    for seed in range(1, 13):
        s = D.signatures(owner, element, np.array(list(a.values()) + list(b.values())), 2, 256, seed)
        assert (s != D._EMPTY).all()
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - true) < 0.03


def test_signature_does_not_depend_on_the_company():
    rng = np.random.default_rng(4)
    sizes = [1, 2, 3000, 40]
    owner = np.repeat(np.arange(4), sizes)
    element = mix64(rng.integers(0, 1 << 50, sum(sizes), dtype=np.uint64), 5)
    together = D.signatures(owner, element, np.ones(len(owner)), 5, 64)
    assert (together[4] == D._EMPTY).all()
    for i in range(4):
        alone = D.signatures(np.zeros(sizes[i], np.int64), element[owner == i], np.ones(sizes[i]), 1, 64)
        assert (alone[0] == together[i]).all()


def test_odd_rows(spark):
    df = odd_documents(spark)
    assert classes(N.near_classes(df)) == brute([(r.doc_id, r.text) for r in df.collect()])
    extra = with_clashes(df, "row_id", "class", "member", "kept", "n")
    assert classes(N.near_classes(extra)) == classes(N.near_classes(df))
    assert N.near_classes(empty_like(df)).count() == 0
    extra = with_clashes(extra, "row", "user", "__row")
    kept = N.near_dedup_stage(extra)
    assert kept.filter("row = 'extra' and user = 'extra' and __row = 'extra'").count() == kept.count()
    assert kept.columns == extra.columns
    assert kept.count() == len({(c, n) for _, c, n in classes(N.near_classes(df))})


def test_near_copies_against_brute_force(spark):
    """A hot group of copies edited to different degrees, chains, and texts that share a passage."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    base, passage = rng.choices(words, k=160), rng.choices(words, k=60)
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t)))
    chain = rng.choices(words, k=120)
    for i in range(25):
        rows.append((300 + i, " ".join(chain)))
        chain = chain[3:] + rng.choices(words, k=3)
    for i in range(60):
        rows.append((500 + i, " ".join(rng.choices(words, k=90) + passage)))
    assert classes(N.near_classes(documents(spark, rows).repartition(5))) == brute(rows)


def test_counted_shingles_weigh(spark):
    one, two = "a b c d e f g h", "u v w x y z"
    rows = [(1, f"{one} {two}"), (2, f"{one} {two} " + f"{two} " * 40), (3, f"{one} {two} " + f"{two} " * 41)]
    got = {r.doc_id: r.class_id for r in N.near_classes(documents(spark, rows), weights="count").collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    with pytest.raises(ValueError):
        N.near_classes(documents(spark, rows), weights="idf")


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (205, 203), (203, 201)], "a long, b long")
    got = defaultdict(set)
    for r in N.connect(links).collect():
        got[r["class"]].add(r.member)
    assert sorted(map(sorted, got.values())) == [list(range(61)), [100, 101], [201, 203, 205]]
