"""Language identification by multilingual mixture inference.

Method.  A document is a mixture of languages: each of its n-grams comes from
one language, drawn with the document's unknown proportions.  For a set of
languages, expectation-maximisation finds the proportions that make the
document's n-grams likeliest.  The set itself is chosen by penalised
likelihood: starting from the best single language, the language that raises
the likelihood most is added as long as the gain pays for one more
proportion.  The predicted language is the one with the largest proportion in
the chosen set, and that proportion is the score.

Few additions are ever fitted, by two bounds that lose none.  The mixture of all
languages, fitted once for all documents of a batch by matrix products, bounds the
likelihood of every set; where the chosen set is within the price of one more
language of it, the search ends.  Else one matrix product gives for every language
l the sum G of count x chance in l / chance in the mixture; by Jensen's inequality
l cannot raise the log-likelihood by more than n log(max G / n), and languages
are fitted, the most promising first, only while that could still win.

The n-grams are ``GRAM`` bytes of the text, lower-cased, with everything but
letters as one separator value, hashed into ``2 ** BUCKET_BITS`` buckets.
Buckets that tell languages apart in the same way (the same likeliest and
second language and the same odds, in ``LEVELS`` steps) form one symbol; of a
likeliest language the ``CLOSE`` commonest second ones are told apart and the
others count as one, whatever the number of languages.  The model is each
language's distribution over the symbols; so a document is one short count vector, whatever its length, and all documents of a batch go
through the inference together.

Learning.  At most ``SAMPLE`` documents of each language of the learning folds
are counted, picked by a hash of the id; of rows that repeat an id in a language one counts.  They are counted on the
executors, a language in ``SLICES`` tasks at most; the driver gets counts of at most ``2 ** BUCKET_BITS`` buckets a language, never texts, and the model is
a table of that size.

Scale.  Prediction is one pass over Arrow batches without a shuffle; texts are
read whole, in pieces of at most ``PIECE`` bytes.

Defined cases.  A text that is null or has no letter is ``und`` with score 0.
A text whose n-grams were never seen in learning gets the commonest language
with score 1 / number of languages; without any labelled document every text
is ``und``.  Equally likely languages go to the alphabetically first.
Repeated rows are judged row by row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curato.llm.common import doc_runs, freed, held_out, mix64, pieces, staged, table, utf8_buffers

SAMPLE = 300
SLICES = 4               # tasks that count the sampled texts of a language, at most
GRAM = 4
BUCKET_BITS = 17
LEVELS = 12
CLOSE = 11               # of each language, the second languages that symbols tell apart
CELLS = 1 << 22          # counts of documents by symbols that are in memory at once
ROUNDS = 12
ALL_ROUNDS = 20          # of the mixture of all languages
PENALTY = 3.0            # log-likelihood that one more language must gain, besides half the log of the size
PIECE = 1 << 20
MAX_BROADCAST = 100_000  # rows of two columns; beyond, a join shuffles
UNKNOWN = "und"

# Separators: all ASCII but letters.  Bytes of other letters stay.
_LETTERS = np.zeros(256, dtype=np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def gram_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every n-gram of a piece that holds a letter and
    lies within its document (with a separator before and after the text)."""
    lens = np.diff(offsets)
    at = np.arange(len(lens))
    spaced = np.zeros(int(offsets[-1]) + 2 * len(lens), dtype=np.uint8)
    spaced[np.arange(int(offsets[-1])) + np.repeat(2 * at + 1, lens)] = _LETTERS[raw]
    code = np.zeros(max(0, len(spaced) - GRAM + 1), dtype=np.uint32)
    for j in range(GRAM):
        code = (code << np.uint32(8)) | spaced[j:j + len(code)]
    doc = np.repeat(at, lens + 2)[:len(code)]
    last = (offsets[1:] + 2 * at + 2 - GRAM)[doc]
    good = (code != 0) & (np.arange(len(code)) <= last)
    # Runs of separators look like one: n-grams with two neighbouring ones say nothing new.
    pair = (code & np.uint32(0xFFFF)) == 0
    for shift in (8, 16):
        pair |= (code >> np.uint32(shift)) & np.uint32(0xFFFF) == 0
    good &= ~pair
    hashed = mix64(code[good].astype(np.uint64)) >> np.uint64(64 - BUCKET_BITS)
    return doc[good], hashed.astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    symbol: np.ndarray      # bucket -> symbol; 0 is "never seen"
    chance: np.ndarray      # (symbols, languages): probability of the symbol in the language
    common: int             # the language with the most learning documents

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, symbols) counts of the n-grams."""
        n, k = len(offsets) - 1, len(self.chance)
        out = np.zeros((n, k))
        for first, part, offs in pieces(raw, offsets, PIECE):
            doc, bucket = gram_buckets(part, offs)
            got = np.bincount(doc * k + self.symbol[bucket], minlength=(len(offs) - 1) * k)
            out[first:first + len(offs) - 1] += got.reshape(-1, k)
        return out

    def _fit(self, counts: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over each document's own language set (documents, set size):
        (log-likelihood, proportions)."""
        p = self.chance.T[langs]                                  # documents x set x symbols
        share = np.full(langs.shape, 1.0 / langs.shape[1])
        total = np.maximum(counts.sum(1), 1e-12)[:, None]
        for _ in range(ROUNDS if langs.shape[1] > 1 else 0):
            mix = np.maximum(np.einsum("dl,dlk->dk", share, p), 1e-300)
            share = share * np.einsum("dlk,dk->dl", p, counts / mix) / total
        mix = np.maximum(np.einsum("dl,dlk->dk", share, p), 1e-300)
        return (counts * np.log(mix)).sum(1), share

    def _ceiling(self, counts: np.ndarray, seen: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(more than the log-likelihood of any mixture, proportions of a fitted mixture of all languages)."""
        share = np.full((len(counts), len(self.langs)), 0.5 / len(self.langs))
        share[np.arange(len(counts)), chosen] += 0.5
        for turn in range(ALL_ROUNDS + 1):
            mix = np.maximum(share @ self.chance.T, 1e-300)
            pull = (counts / mix) @ self.chance
            if turn < ALL_ROUNDS:
                share = share * pull / seen[:, None]
        return (counts * np.log(mix)).sum(1) + seen * np.log(pull.max(1) / seen), share

    def _additions(self, counts: np.ndarray, seen: np.ndarray, chosen: np.ndarray, held: np.ndarray, best: np.ndarray,
                   price: np.ndarray, hint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gain, language, proportions) of the best addition to each document's set,
        the gain -inf where none is worth its price."""
        n, width = chosen.shape
        total = len(self.langs)
        mix = np.maximum(np.einsum("dl,dlk->dk", held, self.chance.T[chosen]), 1e-300)
        pull = (counts / mix) @ self.chance
        own = np.take_along_axis(pull, chosen, 1).max(1)
        start = (counts * np.log(mix)).sum(1) - best
        most = start[:, None] + seen[:, None] * np.log(np.maximum(pull, own[:, None]) / seen[:, None])
        np.put_along_axis(most, chosen, -np.inf, 1)
        gain, add = np.full(n, -np.inf), np.zeros(n, dtype=np.int64)
        share = np.zeros((n, width + 1))
        order = np.argsort(-hint, axis=1, kind="stable")
        left = np.take_along_axis(most, order, 1)                 # bounds in the order of trial
        rest = np.maximum.accumulate(left[:, ::-1], axis=1)[:, ::-1]
        for turn in range(total):
            open_ = rest[:, turn] >= np.maximum(gain, price)
            if not open_.any():
                break
            rows = np.flatnonzero(open_ & (left[:, turn] >= np.maximum(gain, price)))
            if not len(rows):
                continue
            lang = order[rows, turn]
            ll, got = self._fit(counts[rows], np.concatenate([chosen[rows], lang[:, None]], axis=1))
            up = ll - best[rows]
            better = (up > price[rows]) & ((up > gain[rows]) | ((up == gain[rows]) & (lang < add[rows])))
            at = rows[better]
            gain[at], add[at], share[at] = up[better], lang[better], got[better]
        return gain, add, share

    def infer(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(predicted language, its share, number of languages) of each document."""
        counts = counts[:, 1:] / GRAM     # neighbouring n-grams overlap: GRAM of them count as one
        seen = counts.sum(1)
        n, total = len(counts), len(self.langs)
        model = Model(self.langs, self.symbol, self.chance[1:], self.common)
        single = counts @ np.log(model.chance)
        pred = single.argmax(1)
        best = single[np.arange(n), pred]
        score, size = np.ones(n), np.ones(n, dtype=np.int64)
        # Documents of one language share most symbols: a few at a time, with the symbols that they have.
        order = np.argsort(pred, kind="stable")
        order = order[seen[order] > 0] if total > 1 else order[:0]
        most = max(16, (1 << 16) // len(model.chance))
        for a in range(0, len(order), most):
            rows = order[a:a + most]
            used = np.flatnonzero(counts[rows].any(0))
            part = Model(self.langs, self.symbol, np.ascontiguousarray(model.chance[used]), self.common)
            pred[rows], score[rows], size[rows] = part._search(counts[np.ix_(rows, used)], pred[rows], best[rows])
        blank = seen <= 0
        pred[blank], score[blank] = self.common, 1.0 / total
        return pred, score, size

    def _search(self, counts: np.ndarray, pred: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The language sets grown from each document's likeliest language."""
        seen = counts.sum(1)
        n, total = len(counts), len(self.langs)
        pred, best, score, size = pred.copy(), best.copy(), np.ones(n), np.ones(n, dtype=np.int64)
        live = np.arange(n)
        price = PENALTY + 0.5 * np.log(np.maximum(seen, 1))
        ceiling, hint = self._ceiling(counts, seen, pred)
        chosen, held = pred[live][:, None], np.ones((len(live), 1))
        while chosen.shape[1] < total:
            on = ceiling - best[live] > price[live]
            live, ceiling, hint, chosen, held = live[on], ceiling[on], hint[on], chosen[on], held[on]
            if not len(live):
                break
            gain, add, share = self._additions(counts[live], seen[live], chosen, held, best[live], price[live], hint)
            grown = gain > price[live]
            live, ceiling, hint, held = live[grown], ceiling[grown], hint[grown], share[grown]
            chosen = np.concatenate([chosen[grown], add[grown][:, None]], axis=1)
            best[live] += gain[grown]
            top = held.argmax(1)
            pred[live], score[live] = np.take_along_axis(chosen, top[:, None], 1)[:, 0], held.max(1)
            size[live] = chosen.shape[1]
        return pred, score, size

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        most = max(1, CELLS // len(self.chance))
        out = [self.infer(self.counts(raw[offsets[c]:offsets[d]], offsets[c:d + 1] - offsets[c]))
               for a, b in doc_runs(offsets, PIECE) for c in range(a, b, most) for d in [min(b, c + most)]]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def learn(sample: Sequence[tuple[bytes, str]]) -> Model | None:
    """The model of (text, language) rows."""
    langs = sorted({lang for _, lang in sample})
    counts = np.zeros((len(langs), 1 << BUCKET_BITS))
    for i, lang in enumerate(langs):
        bucket, n = _gram_counts([text for text, x in sample if x == lang])
        counts[i, bucket] = n
    return fit(langs, counts, [sum(1 for _, x in sample if x == lang) for lang in langs])


def _gram_counts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, occurrences) of the n-grams of some texts."""
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for text in texts:
        raw = np.frombuffer(text, dtype=np.uint8)
        for _, part, offs in pieces(raw, np.array([0, len(raw)]), PIECE):
            np.add.at(total, gram_buckets(part, offs)[1], 1)
    bucket = np.flatnonzero(total)
    return bucket, total[bucket]


def fit(langs: list[str], counts: np.ndarray, documents: Sequence[int]) -> Model | None:
    """The symbols and their distributions from each language's counts of the buckets
    and number of documents; languages are in alphabetical order."""
    if not langs:
        return None
    size = 1 << BUCKET_BITS
    chance = (counts + 0.05) / (counts.sum(1, keepdims=True) + 0.05 * size)
    odds = chance / chance.sum(0)
    order = np.argsort(-odds, axis=0, kind="stable")
    lead = np.take_along_axis(odds, order[:1], 0)[0]
    level = np.minimum((lead * LEVELS).astype(np.int64), LEVELS - 1)
    key = order[0] * LEVELS + level
    seen = counts.sum(0) > 0
    second = order[min(1, len(langs) - 1)]
    common = np.zeros((len(langs), len(langs)))   # n-grams by likeliest and second language
    np.add.at(common, (order[0][seen], second[seen]), counts.sum(0)[seen])
    rank = np.argsort(np.argsort(-common, axis=1, kind="stable"), axis=1)
    key = key * (len(langs) + 1) + np.where(rank[order[0], second] < CLOSE, second, len(langs))
    used, symbol = np.unique(key[seen], return_inverse=True)
    place = np.zeros(size, dtype=np.int32)
    place[seen] = symbol + 1
    table_ = np.zeros((len(used) + 1, len(langs)))
    for i in range(len(langs)):
        table_[:, i] = np.bincount(place, weights=counts[i], minlength=len(used) + 1) + 0.5
    return Model(langs, place, table_ / table_.sum(0), int(np.argmax(documents)))


def language_sample(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """At most ``per_language`` rows (text in UTF-8, lang) of each language of the
    learning folds.  An id counts once in a language, however often it repeats,
    and brings its smallest text.  Ids are picked first, so only the picked
    texts move; and of a language with many ids only those whose hash lies low
    enough to be picked are ranked at all."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    ids = own.select("doc_id", "lang", F.xxhash64(F.lit("lang"), "doc_id").alias("h"))
    sizes = staged(ids.select("doc_id", "lang").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("size")),
                   "language_sizes")
    if sizes.count() <= MAX_BROADCAST:
        sizes = F.broadcast(sizes)
    low = (F.shiftrightunsigned("h", 11).cast("double") / float(1 << 53)) * F.col("size") <= 2 * per_language + 50
    picked = (ids.join(sizes, "lang").filter(low).select("doc_id", "lang", "h").distinct()
              .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
              .filter(F.col("k") <= per_language)
              .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("lang").alias("l")))
    picked = staged(picked, "language_ids")
    if picked.count() <= MAX_BROADCAST:
        picked = F.broadcast(picked)
    same = (F.coalesce(own["doc_id"].cast("string"), F.lit("")) == picked["id"]) & (own["lang"] == picked["l"])
    return (own.join(picked, same).groupBy("id", "lang").agg(F.min("text").cast("binary").alias("text"))
            .select("text", "lang"))


def _partial_counts(sample: DataFrame) -> DataFrame:
    """(lang, bucket, n) of the sampled texts, bucket -1 for their number.  A language is
    counted in at most ``SLICES`` tasks, each of which gives a bucket once: the rows
    depend on the texts, not on the number of partitions or batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total, documents = None, np.zeros(1 << BUCKET_BITS, dtype=np.int64), 0

        def counted() -> pa.RecordBatch:
            bucket = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([own] * (len(bucket) + 1), pa.string()), pa.array(np.append(bucket, -1), pa.int32()),
                 pa.array(np.append(total[bucket], documents), pa.int64())], names=["lang", "bucket", "n"])

        for batch in freed(batches):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):              # the rows come in this order
                if own is not None and lang != own:
                    yield counted()
                    total[:], documents = 0, 0
                texts = batch.column("text").take(pa.array(np.flatnonzero(langs == lang)))
                bucket, n = _gram_counts([x.as_buffer() for x in texts])
                total[bucket] += n
                own, documents = lang, documents + len(texts)
        if own is not None:
            yield counted()

    dealt = sample.withColumn("slice", F.pmod(F.xxhash64("text"), F.lit(SLICES))).repartition("lang", "slice")
    return (dealt.sortWithinPartitions("lang").select("text", "lang")
            .mapInArrow(run, "lang string, bucket int, n bigint"))


def learn_languages(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """The model of the sampled documents, counted on the executors."""
    found = _partial_counts(language_sample(docs, per_language)).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].unique().to_pylist()))
    names = found["lang"].combine_chunks().dictionary_encode()
    at = np.array([langs.index(x) for x in names.dictionary.to_pylist()], dtype=np.int64)[
        names.indices.to_numpy()] if langs else np.zeros(0, np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros((len(langs), 1 << BUCKET_BITS))
    gram = bucket >= 0
    counts[at[gram], bucket[gram]] = n[gram]
    documents = np.zeros(len(langs), dtype=np.int64)
    documents[at[~gram]] = n[~gram]
    return fit(langs, counts, documents)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score and the number of languages found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            if model is None:
                names = np.full(len(letters), UNKNOWN, dtype=object)
                score, n = np.zeros(len(letters)), np.zeros(len(letters), dtype=np.int64)
            else:
                pred, score, n = model.predict(*utf8_buffers(batch.column("text")))
                names = np.where(letters, np.array(model.langs, dtype=object)[pred], UNKNOWN)
                score, n = np.where(letters, np.clip(score, 0, 1), 0.0), np.where(letters, n, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(score, pa.float64()), pa.array(n, pa.int64())],
                names=["doc_id", "held_out", "lang_pred", "score", "n_langs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (docs.select("doc_id", "text", held_out().alias("held_out"), letters.alias("letters"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_langs bigint"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_languages(docs))
