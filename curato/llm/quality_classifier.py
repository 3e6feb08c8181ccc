"""Document quality by a byte-level convolutional network in numpy.

Method.  A text is its UTF-8 bytes.  ``FILTERS`` learned filters of ``WIDTH``
bytes slide over it one byte at a time; a filter's answer is the sum of one
learned number per tap and byte value, so the first layer is a table lookup.
The whole document is covered by chunks of ``CHUNK`` bytes that overlap by half
(every position lies in a chunk, however long the text); each filter is
max-pooled over each chunk, passed through ReLU, averaged over the chunks, and a
logistic unit combines the averages into one probability.

Learning.  On a sample of at most ``SAMPLE`` labelled rows of the learning
folds (to each row of label 1 comes a short cut of its text, so that being short
does not count as a defect) all tables are learned by Adam on the weighted log
loss; through the max only the winning position gets a gradient.  An epoch takes
another part of a long text's chunks, ``TRAIN_CHUNKS`` or what makes the epochs
together see every chunk.  The model
has a fixed size (FILTERS x WIDTH x 256 numbers) and goes to the tasks with the
function.

Scale.  Scoring is one pass over Arrow batches without a shuffle; texts are
read whole, in pieces of at most ``PIECE`` bytes that end on block borders.

Defined cases.  A null or empty text has one chunk of padding and scores by the
filters' offsets.  Without labelled rows of both values every document scores
the share of the label (0.0 when there are none).  Repeated rows are scored row
by row; extra columns are not read by ``score_documents`` and kept by
``quality_stage``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from curato.llm.common import fit_sample, freed, held_out, table, utf8_buffers

SAMPLE = 3000
FILTERS, WIDTH = 20, 6
CHUNK = 512
BLOCK = CHUNK // 2      # chunks start at every block and hold two
TRAIN_CHUNKS = 6
EPOCHS, BATCH, RATE = 16, 64, 0.02
SNIPPET = (4, 90)       # bytes of the short cuts that training adds
PIECE = 1 << 17         # a multiple of BLOCK
THRESHOLD = 0.3


@dataclass
class Network:
    taps: np.ndarray     # (FILTERS, WIDTH, 256); byte 0 pads and answers 0
    offset: np.ndarray   # (FILTERS,)
    combine: np.ndarray  # (FILTERS,)
    bias: float

    def answers(self, padded: np.ndarray) -> np.ndarray:
        """(FILTERS, n) answers at the n = len(padded) - WIDTH + 1 positions."""
        n = len(padded) - WIDTH + 1
        out = np.empty((FILTERS, n), dtype=np.float32)
        one = np.empty(n, dtype=np.float32)
        index = padded.astype(np.intp)
        for f in range(FILTERS):
            np.take(self.taps[f, 0], index[:n], out=out[f], mode="clip")
            for j in range(1, WIDTH):
                np.take(self.taps[f, j], index[j:j + n], out=one, mode="clip")
                out[f] += one
        return out

    def pooled(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, FILTERS): max over each chunk, ReLU, mean over the chunks."""
        n_docs = len(offsets) - 1
        size = np.diff(offsets)
        blocks = np.maximum(1, -(-size // BLOCK))
        first = np.concatenate([[0], np.cumsum(blocks)])
        top = np.zeros((FILTERS, int(first[-1])), dtype=np.float32)  # an empty text's block answers 0
        for doc, at, part, rest in self._parts(raw, offsets):
            # Documents laid out with WIDTH - 1 zero bytes after each, so no window spans two.
            lens = np.diff(part)
            begin = part[:-1] + np.arange(len(lens)) * (WIDTH - 1)
            padded = np.zeros(int(part[-1]) + len(lens) * (WIDTH - 1) + WIDTH, dtype=np.uint8)
            spot = np.arange(int(part[-1])) + np.repeat(np.arange(len(lens)) * (WIDTH - 1), lens)
            padded[spot] = rest[:int(part[-1])]
            tail = rest[int(part[-1]):int(part[-1]) + WIDTH - 1]
            if len(tail):  # a long document goes on in the next part
                padded[int(spot[-1]) + 1:int(spot[-1]) + 1 + len(tail)] = tail
            answer = self.answers(padded)
            for k in range(len(lens)):
                if lens[k]:
                    cuts = np.arange(0, lens[k], BLOCK)
                    own = answer[:, begin[k]:begin[k] + lens[k]]
                    b = int(first[doc + k]) + at
                    top[:, b:b + len(cuts)] = np.maximum.reduceat(own, cuts, axis=1)
        # A chunk is a block and the next one of the same document.
        last = np.zeros(top.shape[1], dtype=bool)
        last[first[1:] - 1] = True
        chunk = np.maximum(top[:, :-1], top[:, 1:]) if top.shape[1] > 1 else top[:, :0]
        chunk = np.concatenate([chunk, top[:, -1:]], axis=1)
        chunk[:, last] = top[:, last]
        alone = blocks == 1
        active = np.maximum(chunk + self.offset[:, None], 0)
        # The last block of a longer document lies in the chunk before it already.
        active[:, last & ~np.repeat(alone, blocks)] = 0
        sums = np.add.reduceat(active, first[:-1], axis=1) if n_docs else np.zeros((FILTERS, 0))
        return (sums / np.maximum(1, blocks - 1)).T

    def _parts(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first document, its first block in this part, part offsets, bytes from the part's start)."""
        a, n = 0, len(offsets) - 1
        while a < n:
            b = int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1
            if b > a:
                yield a, 0, offsets[a:b + 1] - offsets[a], raw[offsets[a]:offsets[b]]
                a = b
                continue
            start, end = int(offsets[a]), int(offsets[a + 1])
            for at in range(start, end, PIECE):
                stop = min(end, at + PIECE)
                yield (a, (at - start) // BLOCK, np.array([0, stop - at]), raw[at:min(end, stop + WIDTH - 1)])
            a += 1

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = self.pooled(raw, offsets) @ self.combine + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def constant(probability: float) -> Network:
    p = min(max(probability, 1e-13), 1 - 1e-13)
    return Network(np.zeros((FILTERS, WIDTH, 256), np.float32), np.zeros(FILTERS, np.float32),
                   np.zeros(FILTERS, np.float32), float(np.log(p / (1 - p))))


def _chunk_starts(size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """For each epoch the starts of the chunks that it learns from: all of a short
    text, of a long one the next part of a shuffled round, so that all are seen."""
    starts = np.arange(0, max(1, size - BLOCK), BLOCK)
    n = max(TRAIN_CHUNKS, -(-len(starts) // EPOCHS))
    if len(starts) <= n:
        return [starts] * EPOCHS
    order = rng.permutation(starts)
    return [np.take(order, np.arange(e * n, (e + 1) * n), mode="wrap") for e in range(EPOCHS)]


def _chunks(text: bytes, starts: np.ndarray) -> np.ndarray:
    """The chunks at some starts, padded with 0."""
    raw = np.frombuffer(text, dtype=np.uint8)
    out = np.zeros((len(starts), CHUNK + WIDTH - 1), dtype=np.uint8)
    for i, s in enumerate(starts):
        part = raw[s:s + CHUNK]
        out[i, :len(part)] = part
    return out


def _snippet(text: bytes, rng: np.random.Generator) -> bytes:
    """A short run of whole words from a random place of a text."""
    size = int(rng.integers(*SNIPPET))
    at = int(rng.integers(0, max(1, len(text) - size)))
    at = text.find(b" ", at, at + 200) + 1
    end = text.find(b" ", at + size, at + size + 200)
    return text[at:end if end >= 0 else at + size]


def learn(sample: Sequence[tuple[bytes, int, float]], seed: int = 11) -> Network:
    """Fit the network on (text, label, weight) rows."""
    rng = np.random.default_rng(seed)
    sample = list(sample) + [(_snippet(t, rng), label, 0.3 * w) for t, label, w in sample if label]
    y = np.array([r[1] for r in sample], dtype=np.float32)
    weight = np.array([r[2] for r in sample], dtype=np.float32)
    prior = float((y * weight).sum() / weight.sum()) if len(sample) else 0.0
    if not 0 < prior < 1:
        return constant(prior)
    weight /= weight.mean()
    starts = [_chunk_starts(len(r[0]), rng) for r in sample]
    taps = rng.normal(0, 0.3, (FILTERS, WIDTH, 256)).astype(np.float32)
    taps[:, :, 0] = 0
    net = Network(taps, np.zeros(FILTERS, np.float32), rng.normal(0, 0.5, FILTERS).astype(np.float32),
                  float(np.log(prior / (1 - prior))))
    params = [net.taps, net.offset, net.combine, np.array([net.bias], np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, span = 0, CHUNK + WIDTH - 1
    for epoch in range(EPOCHS):
        order = rng.permutation(len(sample))
        for a in range(0, len(order), BATCH):
            own = order[a:a + BATCH]
            block = np.concatenate([_chunks(sample[i][0], starts[i][epoch]) for i in own])
            doc = np.repeat(np.arange(len(own)), [len(starts[i][epoch]) for i in own])
            per = np.bincount(doc, minlength=len(own)).astype(np.float32)
            flat = np.concatenate([block.ravel(), np.zeros(WIDTH - 1, np.uint8)])
            answer = net.answers(flat).reshape(FILTERS, len(block), span)[:, :, :CHUNK]
            at = answer.argmax(2)
            best = np.take_along_axis(answer, at[:, :, None], 2)[:, :, 0] + net.offset[:, None]
            active = np.maximum(best, 0)
            mean = np.stack([np.bincount(doc, weights=active[f], minlength=len(own)) for f in range(FILTERS)]) / per
            z = net.combine @ mean + net.bias
            g = weight[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) / len(own)
            back = net.combine[:, None] * (g / per)[doc][None, :] * (best > 0)
            base = (np.arange(len(block)) * span)[None, :] + at
            d_taps = np.zeros_like(net.taps)
            for f in range(FILTERS):
                for j in range(WIDTH):
                    d_taps[f, j] = np.bincount(flat[base[f] + j], weights=back[f], minlength=256)
            d_taps[:, :, 0] = 0
            grads = [d_taps, back.sum(1), mean @ g, np.array([g.sum()])]
            step += 1
            for p, d, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            net.bias = float(params[3][0])
    return net


def score_documents(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            score = net.scores(*utf8_buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text", held_out().alias("held_out"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))


def quality_stage(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the network accepts, all columns as they came.

    The batches pass through with a flag, so no join is needed to act on it."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            score = net.scores(*utf8_buffers(batch.column(names.index("text"))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, learn(fit_sample(docs, labels, "quality", SAMPLE)))
