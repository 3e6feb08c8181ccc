"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every document gets its base counts; a document that fails the base rule is
rejected at once, and the others pass through the cascade: rules are tried one
after another and the first that fails rejects, so later rules cost nothing
for that document.

Method.  The rules' order is planned before the run: on a bounded sample each
rule's cost (the characters, words and lines it walks, weighted by what a unit
costs) and its selectivity (the share of the documents it rejects) are
estimated, and the rules are sorted by rejection per cost,
dearest rejection last.  The verdict is the same in any order, so the sample
decides speed only, never a result.

Scale.  Everything is computed inside a document's row: no shuffle, no Python.
Repeated windows are found by sorting a row's own packed (hash, position)
numbers and comparing the words of neighbours of equal hash; where these differ,
all windows of equal hashes are sorted by their words instead, so a collision
of hashes neither counts as a repeat nor hides one.

Defined cases.  A null text has no words and fails the base rule.  Texts of
over 16.7 million words are counted by a slower form with the same result.
Repeated rows and null ids are judged row by row.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.llm.common import SPACE, WORD, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SAMPLE_ROWS = 256
POSITION_BITS = 24
SYMBOLS = "[#*$%&|<>]"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule that rejects where ``fails`` holds; ``cost`` is what checking one
    document takes, in units of one character walked."""

    name: str
    fails: Column
    cost: Column


def default_rules() -> list[Rule]:
    """The production rules.  The shares are of words, lines or letters."""
    n, text = F.col("n_words"), F.col("__text")
    flat = F.lit(1.0)  # reads base counts only
    chars = F.length(text).cast("double")
    per_word = n * 8.0
    words = F.col("__words")
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    with_letter = F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
    short_lines = F.size(F.filter(F.split(text, "\n"), lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
    return [
        Rule("word_length", ~F.col("word_chars").between(2 * n, 15 * n), flat),
        Rule("symbols", 10 * F.col("n_symbols") > n, flat),
        Rule("dup_lines", (F.col("n_dup_lines") > 3) & (10 * F.col("n_dup_lines") > 3 * F.size(F.split(text, "\n"))),
             chars),
        Rule("shouting", 2 * upper > letters, 4 * chars),
        Rule("wordless", 10 * with_letter < 6 * n, per_word),
        Rule("cut_lines", 10 * short_lines > 3 * F.size(F.split(text, "\n")), 3 * chars),
    ]


# -- base counts -------------------------------------------------------------------

def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])


def _same_window(words: Column, p: Column, q: Column) -> Column:
    same = F.get(words, p) == F.get(words, q)
    for k in range(1, WINDOW):
        same = same & (F.get(words, p + k) == F.get(words, q + k))
    return same


def _covered(starts: Column) -> Column:
    """Number of words in the windows that start at the given positions."""
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (WINDOW - 1)))))).cast("long")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside windows of three that occur twice or more."""
    mask = F.lit((1 << POSITION_BITS) - 1).cast("long")
    windows = F.sequence(F.lit(0), n.cast("int") - WINDOW)

    def packed(i: Column) -> Column:
        return F.shiftleft(_window_hash(words, i), POSITION_BITS).bitwiseOR(i.cast("long"))

    def position(x: Column) -> Column:
        return x.bitwiseAND(mask).cast("int")

    def close(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS), F.lit(False))

    def exact(starts: Column) -> Column:
        """The same from (words, position) entries: for positions past 24 bits and colliding hashes."""
        entries = F.array_sort(F.transform(starts, lambda i: F.struct(
            F.concat_ws(" ", F.slice(words, i + 1, F.lit(WINDOW))).alias("w"), i.alias("p"))))
        return _covered(_bound(entries, lambda s: F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False))
                     | F.coalesce(F.get(s, i - 1)["w"] == x["w"], F.lit(False))), lambda x: x["p"])))

    def shared(s: Column) -> Column:
        """The entries of the runs of two or more equal hashes."""
        return F.filter(s, lambda x, i: close(x, F.get(s, i + 1)) | close(x, F.get(s, i - 1)))

    def counted(s: Column) -> Column:
        # Runs whose neighbours all have the same words hold one window each, and all of it repeats.
        clash = F.filter(s, lambda x, i: close(x, F.get(s, i + 1))
                         & ~_same_window(words, position(x), position(F.get(s, i + 1))))
        starts = F.transform(s, position)
        return F.when(F.size(clash) == 0, _covered(starts)).otherwise(exact(starts))

    fast = _bound(_bound(F.array_sort(F.transform(windows, packed)), shared), counted)
    return (F.when(n < WINDOW, F.lit(0).cast("long")).when(n < (1 << POSITION_BITS), fast)
            .otherwise(exact(windows)))


def with_base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with its words and the base counts."""
    # The generator makes the words a column of its own: expressions that walk them
    # read it, where the optimizer would else put the split into each of their steps.
    words = F.explode(F.array(F.regexp_extract_all("__text", F.lit(WORD), F.lit(0))))
    lines = F.filter(F.split("__text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
            .select("*", words.alias("__words"))
            .withColumn("n_words", F.size("__words").cast("long"))
            .withColumn("word_chars", F.length(F.regexp_replace("__text", SPACE, "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count("__text", F.lit(SYMBOLS)).cast("long"))
            .withColumn("n_dup_lines", _bound(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long"))
            .withColumn("n_repeat_words", _repeat_words(F.col("__words"), F.col("n_words"))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# -- the cascade --------------------------------------------------------------------

def plan_cascade(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` sorted by rejection per cost, estimated on those of the first ``sample_rows``
    documents that pass the base rule.  Rules that never reject come last, the
    cheap ones first; ties keep the given order.

    The sample is read partition by partition until it is full, whether or not its
    documents pass the base rule, so it costs the same where few pass; it brings
    flags and one number per rule to the driver, not texts."""
    if not rules:
        return []
    measures = [c for i, r in enumerate(rules) for c in (
        F.coalesce(r.fails, F.lit(False)).cast("double").alias(f"s{i}"), r.cost.cast("double").alias(f"c{i}"))]
    read = with_base_counts(docs).select((~base_failed()).alias("passed"), *measures).limit(sample_rows).collect()
    rows = [r for r in read if r["passed"]]

    def rank(i: int) -> tuple[float, float, int]:
        cost = max(1.0, sum(row[f"c{i}"] for row in rows) / max(1, len(rows)))
        return -sum(row[f"s{i}"] for row in rows) / max(1, len(rows)) / cost, cost, i

    return [rules[i] for i in sorted(range(len(rules)), key=rank)]


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first failing rule in the given order, null if none fails."""
    if not rules:
        return F.lit(None).cast("string")
    first = None
    for r in rules:
        first = F.when(r.fails, F.lit(r.name)) if first is None else first.when(r.fails, F.lit(r.name))
    return first


def judge_quality(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, base counts, base_failed, kept and the rule that rejected it."""
    rules = default_rules() if rules is None else list(rules)
    ordered = plan_cascade(docs, rules, sample_rows)
    judged = with_base_counts(docs).withColumn("base_failed", base_failed()).withColumn(
        "rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(ordered)))
    return judged.select("doc_id", *BASE, "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("rejected_by")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
pos AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
tri AS (
  SELECT r, p, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t FROM pos
  WINDOW o AS (PARTITION BY r ORDER BY p)),
rep AS (SELECT r, p FROM (SELECT r, p, t, count(*) OVER (PARTITION BY r, t) AS n FROM tri WHERE t IS NOT NULL) WHERE n > 1),
hit AS (
  SELECT r, count(*) AS n FROM (
    SELECT DISTINCT r, p + k AS p FROM rep, (VALUES (0), (1), (2)) v(k)) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (
  SELECT w.*, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
         len(string_split(text, chr(10))) AS n_lines
  FROM w LEFT JOIN dups USING (r) LEFT JOIN hit USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words
       AND 10 * n_symbols <= n_words
       AND (n_dup_lines <= 3 OR 10 * n_dup_lines <= 3 * n_lines)
       AND 2 * length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) <= length(regexp_replace(text, '[^\p{L}]+', '', 'g'))
       AND 10 * len([x for x in words if regexp_matches(x, '\p{L}')]) >= 6 * n_words
       AND 10 * len([x for x in string_split(text, chr(10)) if regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')])
           <= 3 * n_lines AS kept
FROM c
"""
