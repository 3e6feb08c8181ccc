"""Toxicity by a factorization machine over hashed terms.

Method.  A document's terms are its words and the beginnings of its longer
words (lower-cased bytes between white space and ASCII punctuation), hashed.
The model scores

    b + sum w[t] + sum over pairs <v[t], v[u]>

over the distinct terms present, so besides each term's own weight it learns
what two terms mean together (an insult next to a group mention), which a
linear model cannot.  The pair sum is computed in linear time from the sums of
the terms' vectors.

Learning.  On a sample of at most ``SAMPLE`` labelled rows of the learning
folds two kinds of hashes become terms of the machine: the ``TERMS`` that tell the
classes apart best by themselves (likelihood ratio), and the ``TERMS`` that do so best
in a pair, beyond what its two hashes tell alone.  All pairs of the ``PAIRED`` most frequent
hashes are tested, so a term is not lost for saying nothing alone; with every
hash as a term the machine learns the sample by heart (held-out AUC 0.75).
Texts stay on the executors: the driver gets the number of documents of each hash and
label, and then one bit per document and candidate hash (``TERMS`` + ``PAIRED`` at most).
Weights and vectors are learned by Adam on the weighted log loss.  The model has a
fixed size (2 x ``TERMS`` x (1 + ``FACTORS``) numbers at most) and goes to the tasks
with the function.

Scale.  Scoring is one pass over Arrow batches without a shuffle.  Texts are
read whole, in pieces of at most ``PIECE`` bytes.

Defined cases.  A null or empty text has no terms and scores by the intercept.
Without labelled rows of both values every document scores the share of toxic
labels (0.0 when there are none).  Repeated rows are scored row by row; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.llm.common import (Words, doc_runs, fit_rows, freed, held_out, label_weights, pieces, staged, table, utf8_buffers,
                               word_table)

SAMPLE = 6000
TERMS = 1024
FACTORS = 6
BUCKET_BITS = 20
MIN_DOCS = 4
GAIN, PAIR_GAIN = 6, 40     # least likelihood ratios; there are many more pairs
PAIRED = 2048
BEGINNINGS = (5, 6, 7, 8)   # bytes of a word's beginning that form a term of their own
STEPS, RATE, DECAY = 300, 0.05, 3e-6
PIECE = 1 << 20
THRESHOLD = 0.5
# ASCII white space, controls and punctuation separate words.
_TABLE = word_table(bytes(range(0x30)) + b":;<=>?@[\\]^_`{|}~\x7f")


def term_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every term occurrence of a piece."""
    words = Words(raw, offsets, _TABLE)
    size = words.end - words.start
    docs, hashes = [words.doc], [words.hashes()]
    for n in BEGINNINGS:
        longer = np.flatnonzero(size > n)
        docs.append(words.doc[longer])
        hashes.append(words.hashes(longer, n) ^ np.uint64(n))
    return np.concatenate(docs), (np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def presence(place: np.ndarray, terms: int, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x terms, 1 where the document has the term; ``place`` maps buckets to terms, others to -1."""
    x = np.zeros((len(offsets) - 1, terms), dtype=np.float32)
    for first, part, offs in pieces(raw, offsets, PIECE):
        doc, bucket = term_buckets(part, offs)
        at = place[bucket]
        known = at >= 0
        x[first + doc[known], at[known]] = 1
    return x


def document_counts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of documents that have it)."""
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for a, b in doc_runs(offsets, PIECE):
        # A long text comes in several pieces, so its buckets are made distinct over all of them.
        pairs = [np.unique((first + doc) << BUCKET_BITS | bucket)
                 for first, part, offs in pieces(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], PIECE)
                 for doc, bucket in [term_buckets(part, offs)]]
        if pairs:
            np.add.at(total, np.unique(np.concatenate(pairs)) & ((1 << BUCKET_BITS) - 1), 1)
    bucket = np.flatnonzero(total)
    return bucket, total[bucket]


@dataclass
class Machine:
    place: np.ndarray    # bucket -> term number, -1 for the other buckets
    bias: float
    weight: np.ndarray   # (terms,)
    factor: np.ndarray   # (terms, FACTORS)

    def presence(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Documents x terms, 1 where the document has the term."""
        return presence(self.place, len(self.weight), raw, offsets)

    def logits(self, x: np.ndarray) -> np.ndarray:
        mixed = x @ self.factor
        pairs = 0.5 * ((mixed ** 2).sum(1) - x @ (self.factor ** 2).sum(1))
        return self.bias + x @ self.weight + pairs

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.empty(len(offsets) - 1)
        for a, b in doc_runs(offsets, PIECE):
            z = self.logits(self.presence(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
            out[a:b] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _packed(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def learn(sample: Sequence[tuple[bytes, int, float]], seed: int = 7) -> Machine:
    """Fit the machine on (text, label, weight) rows."""
    y = np.array([r[1] for r in sample], dtype=np.float32)
    weight = np.array([r[2] for r in sample], dtype=np.float32)
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for v in (0, 1):
        bucket, n = document_counts(*_packed([r[0] for r in sample if r[1] == v]))
        counts[v, bucket] = n
    known = candidates(counts, y)
    raw, offsets = _packed([r[0] for r in sample])
    place = _places(known)
    x = [presence(place, len(known), raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
         for a, b in doc_runs(offsets, PIECE)]
    return fit(known, np.concatenate(x) if x else np.zeros((0, len(known)), np.float32), y, weight, counts, seed)


def learn_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE) -> Machine:
    """The machine of at most ``bound`` labelled documents, whose terms are counted where they are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            of = batch.column("label").to_numpy()
            for v in (0, 1):
                texts = batch.column("text").take(pa.array(np.flatnonzero(of == v)))
                bucket, n = document_counts(*utf8_buffers(texts))
                yield pa.RecordBatch.from_arrays([pa.array([v] * len(n), pa.int32()), pa.array(bucket, pa.int32()),
                                                  pa.array(n, pa.int64())], names=["label", "bucket", "n"])

    picked, total = fit_rows(docs, labels, label, bound)
    rows = staged(picked, "labelled")      # read twice; ``bound`` rows
    found = (rows.select("label", "text").mapInArrow(count, "label int, bucket int, n bigint")
             .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((2, 1 << BUCKET_BITS))
    counts[found["label"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    known = candidates(counts, rows.select("label").orderBy("label").toArrow()["label"].to_numpy())
    place = _places(known)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            raw, offsets = utf8_buffers(batch.column("text"))
            bits = []
            for a, b in doc_runs(offsets, PIECE):
                x = presence(place, len(known), raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                bits += [row.tobytes() for row in np.packbits(x.astype(bool), axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("id"), batch.column("label"),
                                              pa.array(bits, pa.binary())], names=["h", "id", "label", "bits"])

    marked = (rows.select("h", F.col("doc_id").cast("string").alias("id"), "label", "text")
              .mapInArrow(mark, "h bigint, id string, label int, bits binary").orderBy("h", "id").toArrow())
    y = marked["label"].to_numpy()
    size = -(-len(known) // 8)
    bits = np.frombuffer(b"".join(marked["bits"].to_pylist()), dtype=np.uint8).reshape(len(y), size)
    x = np.unpackbits(bits, axis=1, count=len(known)).astype(np.float32) if size else np.zeros((len(y), 0), np.float32)
    return fit(known, x, y.astype(np.float32), label_weights(y, total).astype(np.float32), counts)


def _places(known: np.ndarray) -> np.ndarray:
    place = np.full(1 << BUCKET_BITS, -1, dtype=np.int16)
    place[known] = np.arange(len(known))
    return place


def candidates(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The hashes that may become terms, ascending: those that tell the classes apart by
    themselves, and the most frequent ones."""
    return np.union1d(_alone(counts, y)[0], _often(counts))


def _alone(counts: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the best terms by themselves, every hash's likelihood ratio)."""
    n = np.array([(y == 0).sum(), (y == 1).sum()], dtype=np.float64)
    ratio = _likelihood_ratio(counts, n) if n.all() else np.zeros(counts.shape[1])
    ratio[counts.sum(0) < MIN_DOCS] = 0
    best = np.argsort(-ratio, kind="stable")[:TERMS]
    return best[ratio[best] > GAIN], ratio


def _often(counts: np.ndarray) -> np.ndarray:
    seen = counts.sum(0)
    often = np.argsort(-seen, kind="stable")[:PAIRED]
    return np.sort(often[seen[often] >= MIN_DOCS])


def fit(known: np.ndarray, found: np.ndarray, y: np.ndarray, weight: np.ndarray, counts: np.ndarray, seed: int = 7) -> Machine:
    """Choose the terms and learn their weights, from the candidate hashes ``known`` of each document
    (``found``, documents x candidates) and the documents of each hash and label (``counts``)."""
    prior = float((y * weight).sum() / weight.sum()) if len(y) else 0.0
    if not 0 < prior < 1:
        bias = 30.0 if prior >= 1 else -30.0
        return Machine(_places(known[:0]), bias, np.zeros(1, np.float32), np.zeros((1, FACTORS), np.float32))
    best, ratio = _alone(counts, y)
    often = _often(counts)
    paired = _paired_terms(found[:, np.searchsorted(known, often)], often, y, counts, ratio)
    best = np.concatenate([best, np.setdiff1d(paired, best)])
    place = _places(best)
    rng = np.random.default_rng(seed)
    m = Machine(place, float(np.log(prior / (1 - prior))), np.zeros(max(1, len(best)), np.float32),
                rng.normal(0, 0.02, (max(1, len(best)), FACTORS)).astype(np.float32))
    x = found[:, np.searchsorted(known, best)] if len(best) else np.zeros((len(y), 1), np.float32)
    w = weight / weight.sum()
    params = [np.array([m.bias], np.float32), m.weight, m.factor]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        mixed = x @ m.factor
        z = m.bias + x @ m.weight + 0.5 * ((mixed ** 2).sum(1) - x @ (m.factor ** 2).sum(1))
        g = w * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        xg = x.T @ g
        grads = [np.array([g.sum()], np.float32), xg + DECAY * m.weight,
                 x.T @ (g[:, None] * mixed) - xg[:, None] * m.factor + DECAY * m.factor]
        for p, d, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (d - a)
            b += 0.001 * (d * d - b)
            p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        m.bias = float(params[0][0])
    return m


def _paired_terms(x: np.ndarray, often: np.ndarray, y: np.ndarray, counts: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The hashes of ``often`` that tell the classes apart best together with another one.

    A pair of hashes puts a document in one of four cells (both, either, none).  Its
    gain is the likelihood ratio of the cells against the classes, less those of the two
    hashes alone; a hash counts by its best pair.  ``x`` is documents x ``often``."""
    if len(often) < 2:
        return often[:0]
    n = [float((y == 0).sum()), float((y == 1).sum())]
    alone = [counts[v][often] for v in (0, 1)]
    gain = np.zeros(len(often))
    for a in range(0, len(often), 256):
        rows = slice(a, min(a + 256, len(often)))
        cells = []
        for v in (0, 1):
            own = x[y == v]
            both = (own[:, rows].T @ own).astype(np.float64)
            left, right = alone[v][rows, None] - both, alone[v][None, :] - both
            cells.append((both, left, right, n[v] - both - left - right))
        joint = np.zeros_like(cells[0][0])
        for c0, c1 in zip(*cells, strict=True):
            for v, c in ((0, c0), (1, c1)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    joint += np.where(c > 0, 2 * c * np.log(c * sum(n) / ((c0 + c1) * n[v])), 0)
        gain[rows] = (joint - ratio[often][rows, None] - ratio[often][None, :]).max(1)
    best = np.argsort(-gain, kind="stable")[:TERMS]
    return often[best[gain[best] > PAIR_GAIN]]


def _likelihood_ratio(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """G-squared of each bucket's document frequencies in the two classes."""
    both = counts.sum(0)
    out = np.zeros(counts.shape[1])
    for v in (0, 1):
        for seen, total in ((counts[v], both), (n[v] - counts[v], n.sum() - both)):
            expected = total * n[v] / n.sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                out += np.where(seen > 0, 2 * seen * np.log(seen / expected), 0)
    return out


def score_documents(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            score = machine.scores(*utf8_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text", held_out().alias("held_out"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, learn_toxicity(docs, labels))
