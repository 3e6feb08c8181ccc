import re
from collections import defaultdict

from helpers import documents, empty_like, odd_documents, with_clashes
from pyspark.sql import functions as F

from curato.llm import quality_rules as Q


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i:i + 3])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def base_of(df):
    cols = (*Q.BASE, "base_failed")
    return sorted(((r.doc_id, *(r[c] for c in cols)) for r in df.collect()), key=str)


def test_base_counts_against_brute_force(spark):
    texts = ["a a a a a", "a b c a b c d", "x\nx\n \n\nx y\ny", "# * $ % & | < >", "α β γ " * 30, "a b\x0bc\x0cd\re"]
    df = odd_documents(spark).unionByName(documents(spark, [(100 + i, t) for i, t in enumerate(texts)]))
    expected = sorted(((r.doc_id, *brute_base(r.text)) for r in df.collect()), key=str)
    assert base_of(Q.judge_quality(df)) == expected


def test_slow_form_counts_the_same(spark, monkeypatch):
    df = odd_documents(spark)
    fast = base_of(Q.judge_quality(df))
    words = F.split(F.lit("a b c x a b c y a b a b a b"), " ")
    monkeypatch.setattr(Q, "POSITION_BITS", 1)
    got = spark.range(1).select(Q._repeat_words(words, F.size(words).cast("long")).alias("n")).first().n
    assert got == brute_base("a b c x a b c y a b a b a b")[4]
    assert base_of(Q.judge_quality(df)) == fast     # every text of two words or more by the slow form


def test_colliding_hashes_hide_no_repeat(spark, monkeypatch):
    texts = ["a b c x a b c", "a b c x y z a b c x y z q", "a b c d e f g", "u v w a b c u v w a b d u v w", "a a a a b a a a"]
    df = documents(spark, list(enumerate(texts)))
    expected = sorted(((r.doc_id, *brute_base(r.text)) for r in df.collect()), key=str)
    for hashed in (lambda words, i: F.lit(7).cast("long"), lambda words, i: F.length(F.get(words, i)).cast("long"),
                   lambda words, i: F.xxhash64(F.get(words, i))):
        monkeypatch.setattr(Q, "_window_hash", hashed)
        assert base_of(Q.judge_quality(df)) == expected


def test_order_of_rules_never_changes_the_verdict(spark):
    rows = [(1, " ".join(f"fair{chr(97 + i % 26)}{chr(97 + i // 26)} word" for i in range(60))), (2, " ".join(f"W{i}*** %%% &&&" for i in range(60))),
            (3, " ".join(f"WORD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(80))),
            (4, "\n".join(f"line {i} goes on with more words..." for i in range(20))),
            (5, " ".join(str(i) for i in range(90))), (6, "short")]
    df = documents(spark, rows)
    want = {1: None, 2: "symbols", 3: "shouting", 4: "cut_lines", 5: "wordless", 6: "base"}
    got = {r.doc_id: r for r in Q.judge_quality(df).collect()}
    assert {k: r.rejected_by is None for k, r in got.items()} == {k: v is None for k, v in want.items()}
    assert all(r.kept == (r.rejected_by is None) for r in got.values())
    back = Q.with_base_counts(df).withColumn("why", Q.cascade(list(reversed(Q.default_rules()))))
    flags = {r.doc_id: r.why is None for r in back.filter(~Q.base_failed()).collect()}
    assert all(got[k].kept == v for k, v in flags.items())


def test_plan_puts_cheap_rejections_first(spark):
    df = documents(spark, [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(20)])
    rules = [Q.Rule("never", F.lit(False), F.lit(1.0)), Q.Rule("dear", F.col("doc_id") % 2 == 0, F.lit(1000.0)),
             Q.Rule("cheap", F.col("doc_id") % 2 == 0, F.lit(10.0)), Q.Rule("rare", F.col("doc_id") == 1, F.lit(10.0))]
    assert [r.name for r in Q.plan_cascade(df, rules)] == ["cheap", "rare", "dear", "never"]
    assert [r.name for r in Q.plan_cascade(empty_like(df), rules)][0] == "never"
    assert Q.plan_cascade(df, []) == []


def test_plan_reads_no_more_rows_where_none_pass(spark):
    long = " ".join(f"w{j}" for j in range(60))
    df = documents(spark, [(i, "short" if i < 30 else long) for i in range(60)]).coalesce(1)
    rules = [Q.Rule("dear", F.col("doc_id") >= 30, F.lit(100.0)), Q.Rule("cheap", F.lit(False), F.lit(10.0))]
    assert [r.name for r in Q.plan_cascade(df, rules, 30)] == ["dear", "cheap"]    # none passed: nothing is known
    assert [r.name for r in Q.plan_cascade(df, list(reversed(rules)), 30)] == ["cheap", "dear"]
    assert [r.name for r in Q.plan_cascade(df, list(reversed(rules)), 31)] == ["dear", "cheap"]


def test_empty_table_and_clashing_columns(spark):
    df = odd_documents(spark)
    assert Q.judge_quality(empty_like(df)).count() == 0
    extra = with_clashes(df, "n_words", "kept", "words", "rejected_by")
    assert base_of(Q.judge_quality(extra)) == base_of(Q.judge_quality(df))


def test_no_python_in_the_plan(spark):
    plan = Q.judge_quality(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
