import hashlib
import random
import zlib

import pytest
from helpers import with_clashes

from curato.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        members[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, seq in members.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for node in nodes:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = set()
    for node, who in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        ends = sorted(c for c in who if len(members[c]) == len(node))
        out.add((min(who), len(node), min(nodes[node[:-1]]) if node else None, len(who), len(kids.get(node, [])),
                 sum(n not in kids for n in below),
                 sum((len(nodes[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def trie(spark, rows, **kw):
    got = [tuple(r) for r in T.prefix_trie(spark.createDataFrame(rows, SCHEMA), **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def conversations(rng, n, longest=12, texts=3):
    return [(c, k, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "ccc"][:texts]))
            for c in range(n) for k in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("last", [65_536, 7])
def test_against_brute_force(spark, last):
    rows = conversations(random.Random(1), 60, texts=2)
    random.Random(9).shuffle(rows)
    assert trie(spark, rows, last=last) == brute(rows)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "x"), (0, None, "user", "first"), (0, 5, None, None), (0, 5, None, None), (0, 5, "user", "é😀"),
            (1, 0, "user", None), (-3, 0, "user", "neg"), (-3, 1, "user", "neg"), (-10, 0, "", ""), (7, 1, "user", "alone"),
            (13, 0, "user", "z" * 50_000), (13, 0, "user", "z" * 50_000), (14, 2, "b", "a"), (14, 2, "a", "b")]
    got = trie(spark, rows, last=3)
    assert got == brute(rows)
    df = with_clashes(spark.createDataFrame(rows, SCHEMA), "k", "n", "conv", "d", "x", "depth", "position")
    assert {tuple(r) for r in T.prefix_trie(df).collect()} == got


def test_copies_share_one_path(spark):
    rows = [(c * 5, k, "user", f"t{k}") for c in range(40) for k in range(3)]   # bases keep their own turns
    got = trie(spark, rows, last=5)
    assert got == brute(rows) and len(got) == 4


def test_a_long_conversation_in_slices(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE", 7)
    rows = [(5, k, "user", f"t{k % 10}") for k in range(300)] + [(10, k, "user", f"t{k % 10}") for k in range(250)]
    assert trie(spark, rows, last=50) == brute(rows)


def test_many_ends_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 10)
    rows = [(c * 5, 0, "user", "same") for c in range(100)]
    assert trie(spark, rows) == brute(rows)


def test_empty(spark):
    assert trie(spark, []) == set() and trie(spark, [(None, 1, "user", "x")]) == set()


def test_list_ranks(spark):
    rng = random.Random(5)
    order = list(range(500))
    rng.shuffle(order)
    follow = [(a, a % 2, b, None if b is None else b % 2) for a, b in zip(order, [*order[1:], None], strict=True)]
    arcs = spark.createDataFrame(follow, "node long, arc long, next_node long, next_arc long")
    for last in (1, 20, 1000):
        got = {r.node: r.position for r in T.rank_list(arcs, last).collect()}
        assert got == {a: i for i, a in enumerate(order)}
