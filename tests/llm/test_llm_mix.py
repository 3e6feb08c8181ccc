import hashlib
from collections import defaultdict

import pytest
from helpers import documents, empty_like, odd_documents, with_clashes

from curato.llm import source_mix as M


def share(budget, children):
    """Water-filling, one child at a time: {name: (supply, weight)} -> {name: tokens}."""
    given, open_ = {}, {k: v for k, v in children.items() if v[1] > 0}
    while open_:
        weights = sum(w for _, w in open_.values())
        name = min(open_, key=lambda k: (open_[k][0] / open_[k][1], k))
        supply, weight = open_[name]
        if supply * weights <= budget * weight:
            given[name] = supply
            budget -= supply
            del open_[name]
        else:
            given |= {k: min(s, budget * w // weights) for k, (s, w) in open_.items()}
            break
    return given


def brute(rows, mix):
    leaves = defaultdict(list)
    for doc_id, text, lang, source in rows:
        source = "unknown" if source is None else source
        leaf = (mix.domains.get(source, M.DEFAULT_DOMAIN), lang if lang is not None else "und", source)
        leaves[leaf].append((doc_id, len((text or "").split())))
    total = sum(n for own in leaves.values() for _, n in own)
    supply = {leaf: sum(n for _, n in own) * mix.max_epochs for leaf, own in leaves.items()}

    def below(*path):
        """What the leaves under a node can use: none under a node of weight 0."""
        weights = [mix.domain_weights, mix.language_weights, mix.source_weights]
        return sum(s for leaf, s in supply.items() if leaf[:len(path)] == path
                   and all(weights[k].get(leaf[k], 1) > 0 for k in range(len(path), 3)))

    out = {}
    top = share(total * mix.budget_percent // 100,
                {d: (below(d), mix.domain_weights.get(d, 1)) for d in {x[0] for x in leaves}})
    for d, b in top.items():
        mid = share(b, {k: (below(d, k), mix.language_weights.get(k, 1)) for k in {x[1] for x in leaves if x[0] == d}})
        for k, c in mid.items():
            out |= {(d, k, s): v for s, v in share(c, {
                x[2]: (supply[x], mix.source_weights.get(x[2], 1)) for x in leaves if x[:2] == (d, k)}).items()}
    copies = []
    for leaf, own in leaves.items():
        tokens, budget = sum(n for _, n in own), out.get(leaf)
        whole, rest = (0, -1) if budget is None else (0, 0) if not tokens else divmod(budget, tokens)
        for doc_id, n in sorted(own, key=lambda x: (hashlib.md5("|".join(
                [str(mix.seed), str(whole)] + ([str(x[0])] if x[0] is not None else [])).encode()).hexdigest(), str(x))):
            rest_after = rest - n
            copies.append((doc_id, *leaf, n, whole + (rest >= 0 and rest_after >= 0)))
            rest = rest_after if rest_after >= 0 else -1 if rest >= 0 and n else rest
    return sorted(copies, key=str)


def planned(df, mix):
    return sorted(((r.doc_id, r.domain, r.lang, r.source, r.n_tokens, r.copies)
                   for r in M.mix_plan(df, mix).collect()), key=str)


def corpus(n=400):
    rows = []
    for i in range(n):
        source = "src0" if i % 3 == 0 else f"src{i % 11}"   # one source holds over a third
        rows.append((i, "word " * (1 + i * 7 % 40), ["en", "de", None, "fr"][i % 4], source if i % 50 else None))
    return rows


@pytest.mark.parametrize("mix", [M.PRODUCTION, M.PIPELINE, M.Mix(budget_percent=150, max_epochs=3, seed=2),
                                 M.Mix(budget_percent=0), M.Mix(budget_percent=1000, max_epochs=2),
                                 M.Mix(domain_weights={"forum": 0}, source_weights={"src7": 50}),
                                 M.Mix(language_weights={"de": 0, "en": 3}), M.Mix(source_weights={"src0": 0, "src4": 0}),
                                 M.Mix(domain_weights={"web": 0}, language_weights={"fr": 0}, source_weights={"src2": 0, "src5": 0})])
def test_plan_against_brute_force(spark, mix):
    assert planned(documents(spark, corpus()), mix) == brute(corpus(), mix)


def test_small_buckets_cut_at_the_same_document(spark, monkeypatch):
    want = planned(documents(spark, corpus()), M.PRODUCTION)
    monkeypatch.setattr(M, "BUCKET_ROWS", 3)
    assert planned(documents(spark, corpus()).repartition(6), M.PRODUCTION) == want


def test_shortages_go_to_siblings_before_ancestors(spark):
    """Domain forum has one rich and one poor language; news could take more, but gets only its part."""
    rows = [(1, "a " * 10, "en", "src0")] + [(10 + i, "a " * 10, "de", "src0") for i in range(50)] \
        + [(100 + i, "a " * 10, "en", "src4") for i in range(50)]
    mix = M.Mix(budget_percent=50, max_epochs=1, domain_weights={"forum": 1, "news": 1},
                language_weights={"en": 1, "de": 1})
    leaf = {(r.domain, r.lang): r.budget for r in M.leaf_budgets(M.leaf_rows(documents(spark, rows), mix), mix).collect()}
    half = 101 * 10 * 50 // 100 // 2
    assert leaf[("forum", "en")] == 10 and leaf[("forum", "de")] == half - 10 and leaf[("news", "en")] == half


def poured(leaves, mix, budget):
    """The definition, one token at a time: it goes down the tree to the child that lies furthest
    behind its weight among those under which some leaf of positive weight has supply left."""
    names = [mix.domain_weights, mix.language_weights, mix.source_weights]
    given = {}

    def open_(path):
        return any(leaf[:len(path)] == path and given.get(leaf, 0) < supply
                   and all(names[k].get(leaf[k], 1) > 0 for k in range(3)) for leaf, supply in leaves.items())

    for _ in range(budget):
        path = ()
        for k in range(3):
            children = {leaf[:k + 1] for leaf in leaves if leaf[:k] == path and open_(leaf[:k + 1])}
            if not children:
                return given
            path = min(children, key=lambda c, k=k: (sum(v for x, v in given.items() if x[:k + 1] == c)
                                                      / names[k].get(c[k], 1), c))
        given[path] = given.get(path, 0) + 1
    return given


@pytest.mark.parametrize("zero", [{}, {"language_weights": {"de": 0}}, {"source_weights": {"src1": 0, "src4": 0}},
                                  {"domain_weights": {"books": 0}}, {"language_weights": {"de": 0, "en": 0, "fr": 0}}])
def test_budgets_against_pouring_token_by_token(spark, zero):
    rows = [(i, "w " * (3 + i * 5 % 17), ["en", "de", "fr"][i % 3], f"src{i * 7 % 6}") for i in range(45)]
    mix = M.Mix(**({"budget_percent": 60, "max_epochs": 1, "domain_weights": {"forum": 1, "news": 1, "books": 1},
                    "language_weights": {"en": 2, "de": 1, "fr": 1}} | zero))
    leaves, total = defaultdict(int), 0
    for _, text, lang, source in rows:
        leaves[mix.domains[source], lang, source] += len(text.split())
        total += len(text.split())
    want = poured(leaves, mix, total * 60 // 100)
    got = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(M.leaf_rows(documents(spark, rows), mix), mix).collect()}
    assert all(abs(got.get(k, 0) - want.get(k, 0)) <= 6 for k in leaves)      # whole numbers round at three levels
    assert abs(sum(got.values()) - sum(want.values())) <= 12


def test_odd_rows_stage_and_empty_table(spark):
    df = with_clashes(odd_documents(spark), "domain", "copies", "bucket", "key", "row_id", "n_tokens")
    rows = [(r.doc_id, r.n_tokens, r.copies) for r in M.mix_plan(df, M.Mix(budget_percent=200)).collect()]
    assert len(rows) == df.count() and all(c == 2 for _, n, c in rows if n)
    df = with_clashes(df, "row", "user", "__row", "__copy", "col")
    out = M.mix_stage(df, M.Mix(budget_percent=200))
    assert out.filter("row = 'extra' and user = 'extra' and __row = 'extra' and __copy = 'extra'").count() == out.count()
    assert out.columns == df.columns and out.count() >= 2 * sum(1 for _, n, _ in rows if n)
    assert M.mix_plan(empty_like(df)).count() == 0 and M.mix_stage(empty_like(df)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = M.mix_plan(documents(spark, corpus(40)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
