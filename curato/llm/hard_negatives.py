"""Hard negatives: for every anchor and positive the best rows of another label
that score well below the positive.

An anchor's positives are its first rows of its own label by score; the
negatives of a positive are the first rows of other labels whose score lies
between two shares of the positive's.  A score is an integer inner product.

Method.  Secondary sort: scored pairs carry the key (anchor, descending score,
positives before negatives, id); they are dealt out by anchor and sorted inside
the partitions, and one streaming pass opens a window at each positive and gives
out negatives while they fall into open windows.  It keeps the open windows of
one anchor (``n_pos`` at most) and no list of its pairs.

Scale.  Anchors meet all rows block by block: groups of at most about
``ROW_BLOCK`` rows and ``ANCHOR_BLOCK`` anchors are scored by matrix products of
``AT_ONCE`` anchors, so a task holds a block of rows and a few million scores, and a
row is sent once per ``ANCHOR_BLOCK`` anchors.
A block gives only what can matter: its ``n_pos`` best rows of the anchor's label,
and, once the positives (and so the windows) are known, its ``n_neg`` first rows
in each window.  The best of all rows are among these, so nothing is lost, and
the sort moves a few rows per anchor and block, never all pairs.  Rows are dealt
to blocks by a hash of their unique id, so a common vector or label fills no block.

Defined cases.  Rows with a null id, label or vector, or a null or non-finite
component, take no part.  Of rows with one id, the one with the smallest (label,
vector) takes part.  A vector shorter than another counts as ended by zeros, so an
empty one scores 0.  Scores are 64-bit; larger ones wrap.  Ties go to the smaller
id.  A positive with a negative score has an empty window.  An anchor without
positives, and a positive without negatives, give no rows; neither does an empty
table.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import freed, staged, table

N_POS, N_NEG = 5, 3
LOW_PCT, HIGH_PCT = 50, 95
ROW_BLOCK, ANCHOR_BLOCK = 8192, 4096
AT_ONCE = 256       # anchors of a block that are scored at once
SCALE = 256

_PAIR = pa.schema([("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_PAIR_DDL = "anchor_id bigint, id bigint, score bigint"
_OUT = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
                  ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])
_OUT_DDL = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
            "positive_score bigint, negative_score bigint")


def quantised(embeddings: DataFrame, label: Column) -> DataFrame:
    """(id, label, vector): one row per id, components floor(256 x)."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                             & F.col("embedding").isNotNull() & usable)
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return (rows.select(F.col("vec_id").cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                        vector.alias("vector"))
            .groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*"))


def _matrix(vectors: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """The vectors as rows of one matrix, shorter ones filled with zeros."""
    col = vectors.combine_chunks()
    offsets = col.offsets.to_numpy()
    values = col.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values[offsets[0]:offsets[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    for i, (a, n) in enumerate(zip(offsets[:-1], sizes, strict=True)):
        out[i, :n] = values[a:a + n]
    return out


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products: by floating point where every partial sum is exact there."""
    width = max(anchors.shape[1], rows.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, rows))
    fa, fb = a.astype(np.float64), b.astype(np.float64)
    if np.abs(fa).max(initial=0) * np.abs(fb).max(initial=0) * width < 2.0 ** 53:
        return (fa @ fb.T).astype(np.int64)
    return a @ b.T


def _blocks(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Table, np.ndarray]]:
    """(row ids ascending, row labels, some anchors, their scores anchors x rows)."""
    ids = rows["id"].to_numpy()
    order = np.argsort(ids)
    ids, labels, vectors = ids[order], rows["label"].to_numpy()[order], _matrix(rows["vector"])[order]
    for at in range(0, len(anchors), AT_ONCE):
        part = anchors.slice(at, AT_ONCE)
        yield ids, labels, part, _scores(_matrix(part["vector"]), vectors)


def _best_positives(n_pos: int):
    def best(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for ids, labels, part, scores in _blocks(rows, anchors):
            anchor_ids, anchor_labels = part["id"].to_numpy(), part["label"].to_numpy()
            for label in np.unique(anchor_labels):
                own, same = np.flatnonzero(anchor_labels == label), np.flatnonzero(labels == label)
                first = np.argsort(-scores[np.ix_(own, same)], axis=1, kind="stable")[:, :n_pos + 1]   # the anchor too
                for i, a in enumerate(own):
                    picked = same[first[i]]
                    picked = picked[ids[picked] != anchor_ids[a]][:n_pos]
                    out.append((np.full(len(picked), anchor_ids[a]), ids[picked], scores[a, picked]))
        return _pairs(out)
    return best


def _first_negatives(n_neg: int):
    def first(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for ids, labels, part, scores in _blocks(rows, anchors):
            anchor_ids, anchor_labels = part["id"].to_numpy(), part["label"].to_numpy()
            lows, highs = part["lows"].to_pylist(), part["highs"].to_pylist()
            inside = ((scores >= np.array([min(x) for x in lows], dtype=np.int64).reshape(-1, 1))
                      & (scores <= np.array([max(x) for x in highs], dtype=np.int64).reshape(-1, 1))
                      & (labels[None, :] != anchor_labels[:, None]))
            at, row = np.nonzero(inside)
            value = scores[at, row]
            order = np.lexsort((-value, at))         # stable: equal scores stay in order of their ids
            at, row, value = at[order], row[order], value[order]
            ends = np.searchsorted(at, np.arange(len(anchor_ids) + 1))
            for a in range(len(anchor_ids)):
                down = -value[ends[a]:ends[a + 1]]
                begin = np.searchsorted(down, -np.array(highs[a]))
                stop = np.minimum(begin + n_neg, np.searchsorted(down, -np.array(lows[a]), side="right"))
                picked = sorted({int(i) for b, e in zip(begin, stop, strict=True) for i in range(b, e)})
                picked = np.array(picked, dtype=np.int64) + ends[a]
                out.append((np.full(len(picked), anchor_ids[a]), ids[row[picked]], value[picked]))
        return _pairs(out)
    return first


def _pairs(out: list) -> pa.Table:
    if not out:
        return _PAIR.empty_table()
    return pa.table([np.concatenate([x[i] for x in out]).astype(np.int64) for i in range(3)], schema=_PAIR)


def _blockwise(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, score) -> DataFrame:
    """``score(row block, anchor block)`` for every pair of blocks."""
    n_row, n_anchor = -(-n_rows // ROW_BLOCK) or 1, -(-n_anchors // ANCHOR_BLOCK) or 1

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return (df.toDF(*df.columns)     # columns of its own, as both sides come from one table
                .withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    keys = ["anchor_block", "row_block"]
    return (dealt(rows, "row_block", n_row, "anchor_block", n_anchor).groupBy(*keys)
            .cogroup(dealt(anchors, "anchor_block", n_anchor, "row_block", n_row).groupBy(*keys))
            .applyInArrow(score, _PAIR_DDL))


def _stream(n_neg: int, low: int, high: int):
    """Sorted pairs -> negatives of each positive."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out: list[tuple] = []
            for a, score, kind, i in zip(*(batch[c].to_pylist() for c in ("anchor_id", "score", "kind", "id")), strict=True):
                if a != anchor:
                    anchor, windows = a, []
                if kind == 0:
                    windows.append([i, score, 0])
                    continue
                for w in windows:
                    if w[2] < n_neg and low * w[1] <= 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((a, w[0], w[2], i, w[1], score))
            if out:
                yield pa.record_batch([list(c) for c in zip(*out, strict=True)], schema=_OUT)
    return lambda batches: freed(emit(batches))


def mine(rows: DataFrame, is_anchor: Column, n_pos: int = N_POS, n_neg: int = N_NEG,
         low_pct: int = LOW_PCT, high_pct: int = HIGH_PCT) -> DataFrame:
    """The negatives of every (anchor, positive) of ``rows`` (id, label, vector; ids are
    unique).  ``is_anchor`` picks the anchors by their columns."""
    rows = staged(rows, "vectors")
    anchors = rows.filter(is_anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    best = _blockwise(rows, anchors, n_rows, n_anchors, _best_positives(n_pos))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    positives = staged(best.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n_pos).drop("n"), "positives")

    # A window is low% to high% of a score of 0 or more, in whole numbers.
    open_ = positives.filter("score >= 0").withColumn("wide", F.col("score").cast("decimal(25,0)")) \
        .withColumn("low", F.expr(f"({low_pct} * wide + 99) div 100")) \
        .withColumn("high", F.expr(f"({high_pct} * wide) div 100"))
    windows = open_.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))   # n_pos at most
    negatives = _blockwise(rows, anchors.join(windows, "id"), n_rows, n_anchors, _first_negatives(n_neg))
    pairs = (positives.withColumn("kind", F.lit(0)).unionByName(negatives.withColumn("kind", F.lit(1)))
             .select("anchor_id", "score", "kind", "id"))
    return (pairs.repartition("anchor_id")
            .sortWithinPartitions("anchor_id", F.desc("score"), "kind", "id")
            .mapInArrow(_stream(n_neg, low_pct, high_pct), _OUT_DDL))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return mine(quantised(table(spark, sf_dir, "embeddings"), label), F.col("id") % 50 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, min({'l': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END,
                      'q': [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding]}) AS s
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.s.l = r.s.l AS same,
         CAST(list_inner_product(a.s.q, r.s.q) AS BIGINT) AS score
  FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""
