import random
import re

import pytest
from helpers import documents, empty_like, odd_documents, with_clashes

from curato.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    """(n_words, hit positions, ids): every window of every item at every place."""
    w, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        iw = words_of(item)
        m = min(len(iw), D.WINDOW)
        for i in range(len(iw) - m + 1 if m else 0):
            for p in range(len(w) - m + 1):
                if w[p:p + m] == iw[i:i + m]:
                    hit.update(range(p, p + m))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(w), hit, sorted(ids)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")


def check(spark, docs, items):
    got = D.find_overlaps(docs, bench(spark, items)).collect()
    want = [(r.doc_id, *brute(r.text, items)) for r in docs.collect()]

    def key(x):
        return (x[0] is None, x[0] or 0, x[1], x[2], x[3])

    seen = [(r.doc_id, r.n_words, sorted(p for s in r.spans for p in range(s["first"], s["end"])), list(r["items"])) for r in got]
    assert sorted(seen, key=key) == sorted([(d, n, sorted(h), i) for d, n, h, i in want], key=key)
    for r in got:   # spans are maximal
        assert all(a["end"] < b["first"] for a, b in zip(r.spans, r.spans[1:], strict=False))
    return seen


def sentence(rng, n, vocabulary=30):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("few", [True, False])
def test_against_brute_force(spark, monkeypatch, few):
    if not few:   # the benchmark comes by shuffles
        monkeypatch.setattr(D, "MAX_FINGERPRINTS", 0)
        monkeypatch.setattr(D, "MAX_WINDOW_BYTES", 0)
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.choice([0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 30]), 2000)) for i in range(40)]
    items += [(40, items[-1][1]), (41, "a a a a a a a a a a a a"), (None, sentence(rng, 12)), (3, sentence(rng, 15))]
    docs = []
    for i in range(60):
        text = sentence(rng, rng.randrange(60))
        for _ in range(rng.randrange(4)):
            iw = words_of(rng.choice(items)[1])
            a = rng.randrange(len(iw) + 1)
            text += rng.choice([" ", ". ", " - "]) + " ".join(iw[a:a + rng.randrange(1, 40)]).upper() + " " + sentence(rng, rng.randrange(4))
        docs.append((i % 50, text))
    docs += [(90, "a " * 25), (91, "b a a a a a a a a a a c")]
    seen = check(spark, documents(spark, docs), items)
    assert any(h for *_, h, _ in seen) and not all(h for *_, h, _ in seen)


def test_every_shared_window_is_found(spark):
    # Each document shares exactly ten words with the item, at another place; nine are not enough.
    rng = random.Random(4)
    item = [f"q{i}" for i in range(40)]
    docs = [(i, " ".join([sentence(rng, 20), *item[i:i + 10], sentence(rng, 20)])) for i in range(31)]
    docs += [(100 + i, " ".join([sentence(rng, 20), *item[i:i + 9], sentence(rng, 20)])) for i in range(31)]
    seen = check(spark, documents(spark, docs), [(7, " ".join(item))])
    assert {d: len(h) for d, _, h, _ in seen} == {**{i: 10 for i in range(31)}, **{100 + i: 0 for i in range(31)}}


def test_odd_documents_and_items(spark):
    docs = with_clashes(odd_documents(spark), "row", "runs", "__words", "span", "hit", "head", "__s10")
    items = [(1, None), (2, ""), (3, " ... "), (4, "quick brown fox jumps over the lazy dog again the quick"), (5, "日本語"), (6, "TWO three"), (None, "four five")]
    seen = check(spark, docs, items)
    assert sum(1 for d, *_ in seen if d is None) == 2


def test_empty_tables(spark):
    docs = documents(spark, [(1, "a b c")])
    assert [(n, h, i) for _, n, h, i in check(spark, docs, [])] == [(3, [], [])]
    assert D.find_overlaps(empty_like(docs), bench(spark, [(1, "a b")])).collect() == []


def test_long_text_and_nothing_runs_python(spark):
    text = " ".join(f"v{i % 977}" for i in range(60_000))
    docs = documents(spark, [(1, text), (1, text)])
    found = D.find_overlaps(docs, bench(spark, [(9, " ".join(f"v{i}" for i in range(500, 520)))]))
    rows = found.collect()
    assert len(rows) == 2 and all(sum(s["end"] - s["first"] for s in r.spans) == 20 * (60_000 // 977) for r in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
