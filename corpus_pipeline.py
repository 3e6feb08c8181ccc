"""Training-data pipeline: quality, exact and near dedup, mixing, encoding.

Every stage is one operator of ``curato.llm`` applied to all rows that the
stage before it kept.  All stages but the last return the columns of the
documents as they came; the last returns one row per document with its ids.

A stage's result reads tables that the stage has staged in the shared folder.
It is written before the next stage begins, so each stage first deletes what
the one before it staged, and the disk holds one stage's tables at a time.  ``run``
also deletes a stage's output once the next one is written, so only the last output
stays, which its result reads.

Defined cases.  A null or empty text is scored, deduplicated, budgeted (it has no
words and costs nothing) and encoded as the empty text.  Texts are read whole.  Of
equal or similar documents the one with the smallest doc_id stays (a null id last),
of rows that repeat an id too.  Null languages and sources are leaves of their own in the
mix.  An empty table gives an empty result.  Extra columns come through all stages
but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from curato.llm import exact_dedup, near_dedup, quality_classifier, sentencepiece_bpe, source_mix
from curato.llm.common import fit_sample, recording, table
from curato.session import drop_tables, scratch_path, table_scope


# Tables of the stage before, in this thread: runs in other threads have their own.
_LEFT: ContextVar[tuple[str, ...]] = ContextVar("left", default=())


def _only_own_tables(stage: Callable) -> Callable:
    """A stage that first deletes the tables of the stage before."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, list(_LEFT.get()))
        made: list[str] = []
        try:
            with recording(made):
                return stage(spark, docs, sf_dir)
        finally:
            _LEFT.set(tuple(made))
    return run_stage


@_only_own_tables
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts."""
    sample = fit_sample(docs, table(spark, sf_dir, "labels"), "quality", quality_classifier.SAMPLE)
    return quality_classifier.quality_stage(docs, quality_classifier.learn(sample))


@_only_own_tables
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup_stage(docs)


@_only_own_tables
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.near_dedup_stage(docs)


@_only_own_tables
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that bring the sources to their target weights."""
    return source_mix.mix_stage(docs, source_mix.PIPELINE)


@_only_own_tables
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and the decoded text."""
    return sentencepiece_bpe.encode_documents(docs, sentencepiece_bpe.default_model(), keep=("ids",))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage_{name}")
        with table_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        drop_tables(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained network, a tokenizer and similarity classes are beyond SQL: tests
# hold the stages against brute force.
ORACLE_SQL = None
