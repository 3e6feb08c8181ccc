"""Small inputs that every training-data operator must take."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog again " * 4000


def documents(spark, rows):
    """``rows`` of (doc_id, text[, lang[, source]]) as a documents table."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (list(r) + [None, None])[:4]
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOC_SCHEMA)


#: Nulls in any column, empty and blank texts, a very long text, ties and repeated rows.
ODD_ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, LONG, "en", None),
    (5, "one two three four five six", "en", "a"), (5, "one two three four five six", "en", "a"),
    (None, "one two three four five six", "en", "a"), (None, None, None, None),
    (7, "\x00 nul and é ü 日本語 😀", "de", "b"), (8, "x" * 70000, "en", "b"), (9, "one  two three\nfour five six", "fr", "b"),
    (-3, "1234 !!! ...", "en", "a"),
]


def odd_documents(spark):
    return documents(spark, ODD_ROWS)


def with_clashes(df, *names):
    """The table with extra columns named like the operator's own columns."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("extra"))
    return df


def empty_like(df):
    return df.limit(0)
