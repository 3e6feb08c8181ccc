"""Near-duplicate classes: DartMinHash signatures, banded joins, exact checks.

A document is the set of its shingles (five neighbouring words each, words
being ``[^\\x20\\x09-\\x0D]+``; a shorter text is one shingle of all its words).
Two documents are linked when the Jaccard similarity of their sets is
``SIMILARITY`` or more; a class is what links connect.  With ``weights="count"``
a shingle weighs as often as it occurs and the similarity is the weighted one.

Steps.
1. One pass over the texts makes each document's shingle hashes, its signature
   (``dart_minhash``) and from it ``BANDS`` keys of ``ROWS`` coordinates.
2. Documents with equal sets become one representative, so a group of copies,
   however large, is one row from here on.
3. Representatives that share a band key meet at the key's first one: one
   candidate per member and key, never all pairs of a key.  Each candidate is
   checked exactly on the two sets, and the links' components are classes.
4. What step 3 may have missed are links between two members that both failed
   against the first.  Only documents with enough shared shingles can have one
   (a shingle that no other candidate holds counts against every similarity),
   and they meet again under much sharper keys (``SHARP_KEYS`` keys of
   ``SHARP_ROWS`` coordinates of a longer signature).  In keys that still hold
   several classes the members outside the key's main class are checked
   against the others, as part of the join on the key.

Two documents of similarity 0.8 share no band key with a chance of 2 in
100,000, and (if they failed step 3's candidates too) no sharp key with about
2 in 1,000; higher similarities are missed far more rarely.

Scale.  Every step is a join or aggregate on hashed keys; keys with many
members are aggregated before and split by the adaptive skew join after the
shuffle.  Only members of a key with several are checked, and sets move once.
Intermediate tables are written to the shared folder.  The driver sees only
counts of rows.

Defined cases.  A null text is the empty text.  Texts without a word are one
class.  Of a class the row with the smallest doc_id stays (null ids last; of
rows that repeat an id one).  An empty table gives an empty result.  Extra
columns are ignored by ``near_classes`` and kept by ``near_dedup_stage``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.llm.common import (Words, doc_runs, freed, mix64, numbered_rows, pieces, small_batches, staged, table,
                               utf8_buffers, word_table)
from curato.llm.dart_minhash import band_keys, signatures

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 6, 36
SHARP_LENGTH, SHARP_ROWS, SHARP_KEYS = 512, 16, 400
PIECE = 1 << 20
ROUNDS = 60     # contraction halves the open links each round; more than enough for any size
_SPACES = word_table(b"\t\n\x0b\x0c\r ", lower=False)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 52) - 1)


# -- shingles ------------------------------------------------------------------------

def _join_words(words: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle of word hashes given in text order."""
    n = len(words) - SHINGLE + 1
    owner, made = [], []
    if n > 0:
        whole = doc[:n] == doc[SHINGLE - 1:]
        h = words[:n].copy()
        for j in range(1, SHINGLE):
            h = mix64(h * _PRIME + words[j:j + n])
        owner.append(doc[:n][whole])
        made.append(h[whole])
    count = np.bincount(doc, minlength=docs)
    start = np.concatenate([[0], np.cumsum(count)])
    for d in np.flatnonzero((count > 0) & (count < SHINGLE)):
        h = words[start[d]:start[d] + 1].copy()
        for w in words[start[d] + 1:start[d + 1]]:
            h = mix64(h * _PRIME + w)
        owner.append(np.array([d]))
        made.append(mix64(h, int(count[d]) + 100))
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owner), np.concatenate(made)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, occurrences) of the distinct shingles of some documents,
    sorted by document and hash."""
    words, owner = [], []
    for first, part, offs in pieces(raw, offsets, PIECE):
        found = Words(part, offs, _SPACES)
        words.append(found.hashes())
        owner.append(found.doc + first)
    docs = len(offsets) - 1
    doc, made = _join_words(np.concatenate(words), np.concatenate(owner), docs) if words else (
        np.zeros(0, np.int64), np.zeros(0, np.uint64))
    if docs <= 1 << 12:  # the document's number and 52 bits of the hash sort as one
        both, count = np.unique(doc.astype(np.uint64) << np.uint64(52) | made & _LOW, return_counts=True)
        return (both >> np.uint64(52)).astype(np.int64), both & _LOW, count
    raise ValueError("too many documents in one run")


def _expanded(doc: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set whose plain Jaccard similarity is the weighted one of the counts."""
    at = np.repeat(np.arange(len(h)), count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return doc[at], np.where(nth == 0, h[at], mix64(h[at] * _PRIME + nth.astype(np.uint64)) & _LOW)


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in doc_runs(offsets, PIECE):
        for c in range(a, b, 1 << 12):
            yield c, min(b, c + (1 << 12))


def sketch_documents(docs: DataFrame, row_id: Column, weights: str = "distinct") -> DataFrame:
    """row_id, doc_id, the set's digest (d1, d2, n), its hashes and its band keys."""
    if weights not in ("distinct", "count"):
        raise ValueError(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            raw, offsets = utf8_buffers(batch.column("text"))
            for a, b in _runs(offsets):
                sets = b - a
                doc, h, count = shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                weight = count.astype(np.float64) if weights == "count" else np.ones(len(h))
                keys = band_keys(signatures(doc, h, weight, sets, ROWS * BANDS), ROWS)
                if weights == "count":
                    doc, h = _expanded(doc, h, count)
                n = np.bincount(doc, minlength=sets)
                ends = np.concatenate([[0], np.cumsum(n)])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(h, seed), dtype=np.uint64)]) for seed in (21, 22)]
                digest = [(s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums]
                own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                               pa.array((h & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(sets + 1) * BANDS, pa.int32()),
                                                 pa.array(keys.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id")[a:b], batch.column("doc_id")[a:b], pa.array(digest[0]),
                     pa.array(digest[1]), pa.array(n, pa.int64()), own, bands],
                    names=["row_id", "doc_id", "d1", "d2", "n", "shingles", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(row_id.alias("row_id"), "doc_id", "text").mapInArrow(
        run, f"row_id bigint, doc_id {kind}, d1 bigint, d2 bigint, n bigint, shingles array<int>, bands array<bigint>")


# -- links -----------------------------------------------------------------------------

def check_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their exact intersection."""
    left = sets.select(F.col("member").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("member").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").filter(_near()).select("a", "b")


def _near() -> Column:
    """The similarity of the sets (na, sa) and (nb, sb) is high enough; sizes too
    far apart are seen before the intersection is made."""
    share = round(10 * SIMILARITY)
    both = F.size(F.array_intersect("sa", "sb"))
    return F.when(10 * F.least("na", "nb") < share * F.greatest("na", "nb"), F.lit(False)).otherwise(
        10 * both >= share * (F.col("na") + F.col("nb") - both))


def connect(links: DataFrame) -> DataFrame:
    """(member, class) of every member of a link, by contraction: each node
    joins its neighbour of lowest random rank, and links between what remains
    go to the next round.  Components shrink by a constant factor a round."""
    labels = None
    for turn in range(ROUNDS):
        ranked = F.struct(F.xxhash64(F.lit(turn), "v").alias("rank"), F.col("v"))
        both = (links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        itself = both.select("u", F.col("u").alias("v")).distinct()
        joins = both.unionByName(itself).groupBy("u").agg(F.min(ranked)["v"].alias("to"))
        joins = staged(joins, "cc_joins")
        hop = joins.select(F.col("u").alias("to"), F.col("to").alias("next"))
        joins = staged(joins.join(hop, "to").select("u", F.col("next").alias("to")), "cc_hops")
        if labels is None:
            labels = joins.select(F.col("u").alias("member"), F.col("to").alias("class"))
        else:
            labels = (labels.join(joins.select(F.col("u").alias("class"), "to"), "class", "left")
                      .select("member", F.coalesce("to", "class").alias("class")))
        labels = staged(labels, "cc_labels")
        links = staged(
            links.join(joins.select(F.col("u").alias("a"), F.col("to").alias("x")), "a")
            .join(joins.select(F.col("u").alias("b"), F.col("to").alias("y")), "b")
            .filter(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc_links")
        if links.isEmpty():
            return labels
    raise RuntimeError("links did not contract")


def _sharp_keys(sets: DataFrame) -> DataFrame:
    """(key, member) of the sharp keys, from a longer signature of the set."""
    columns = np.stack([np.random.default_rng(97 + i).choice(SHARP_LENGTH, SHARP_ROWS, replace=False)
                        for i in range(SHARP_KEYS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                own = part.column("shingles")
                flat = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                size = own.value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(part)), size)
                signed = signatures(doc, mix64(flat, 31), np.ones(len(flat)), len(part), SHARP_LENGTH, seed=2)
                keys = np.empty((len(part), SHARP_KEYS), dtype=np.uint64)
                for i in range(SHARP_KEYS):
                    h = np.full(len(part), i + 1, dtype=np.uint64)
                    for j, c in enumerate(columns[i]):
                        h = mix64(h ^ signed[:, c], j + 1)
                    keys[:, i] = h
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()),
                     pa.array(np.repeat(part.column("member").to_numpy(zero_copy_only=False), SHARP_KEYS))],
                    names=["key", "member"])

    return sets.select("member", "shingles").mapInArrow(run, "key bigint, member bigint")


def missed_links(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between members of different classes (step 4).

    Members meet in their keys with their sets and are checked there, so no
    list of candidate pairs is ever made."""
    # Shingles that another candidate holds: only they can count in an intersection.
    held = sets.select("member", F.explode("shingles").alias("s"))
    shared = (held.join(held.groupBy("s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1").select("s"), "s")
              .groupBy("member").agg(F.count(F.lit(1)).alias("k")))
    able = staged(
        sets.join(shared, "member").filter(10 * F.col("k") >= round(10 * SIMILARITY) * F.col("n"))
        .join(labels, "member", "left")
        .select("member", "n", "k", F.coalesce("class", "member").alias("class"), "shingles"), "able")
    keys = _sharp_keys(able).join(able.select("member", "class"), "member")
    # Only keys that hold several classes; the class with most members in the key is its main one.
    per_class = keys.groupBy("key", "class").agg(F.count(F.lit(1)).alias("m"))
    mixed = (per_class.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.max_by("class", "m").alias("main"))
             .filter("classes > 1").select("key", "main"))
    inside = staged(keys.join(mixed, "key").join(able.drop("class"), "member"), "mixed_keys")
    x = inside.filter(F.col("class") != F.col("main")).select(
        "key", F.col("member").alias("a"), F.col("class").alias("ca"), F.col("n").alias("na"), F.col("k").alias("ka"),
        F.col("shingles").alias("sa"))
    y = inside.select("key", F.col("member").alias("b"), F.col("class").alias("cb"), F.col("n").alias("nb"),
                      F.col("k").alias("kb"), F.col("shingles").alias("sb"))
    most = F.least("ka", "kb")   # no intersection is larger than what either shares with anyone
    able_pair = 10 * most >= round(10 * SIMILARITY) * (F.col("na") + F.col("nb") - most)
    met = x.join(y, (x["key"] == y["key"]) & (F.col("ca") != F.col("cb"))
                 & F.when(able_pair, _near()).otherwise(F.lit(False)))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_classes(docs: DataFrame, row_id: Column | None = None, weights: str = "distinct") -> DataFrame:
    """One row per document: row_id, doc_id, class_id (the smallest doc_id of its
    class), class_size and kept (true for one row of each class)."""
    number = F.monotonically_increasing_id() if row_id is None else row_id
    with small_batches(docs.sparkSession):
        rows = staged(sketch_documents(docs, number, weights), "sketches")
    narrow = rows.select("row_id", "doc_id", "d1", "d2", "n")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    reps = staged(narrow.groupBy("d1", "d2", "n").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("member", F.col("stays.row_id")), "reps")
    with_words = reps.filter("n > 0").select(F.col("member").alias("row_id"))
    keys = (rows.select("row_id", "bands").join(with_words, "row_id", "left_semi")
            .select(F.col("row_id").alias("member"), F.explode("bands").alias("key")))
    meeting = (keys.groupBy("key").agg(F.min("member").alias("first"), F.count(F.lit(1)).alias("m"))
               .filter("m > 1").select("key", "first"))
    pairs = staged(keys.join(meeting, "key").filter(F.col("member") != F.col("first"))
                   .select(F.col("first").alias("a"), F.col("member").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("row_id")).distinct()
    # The wanted ids grow with the corpus, so this join is a shuffle at every size.
    sets = staged(rows.select("row_id", "n", "shingles").join(wanted.hint("merge"), "row_id", "left_semi")
                  .withColumnRenamed("row_id", "member"), "sets")
    links = staged(check_pairs(pairs, sets), "links")
    labels = connect(links)
    more = staged(missed_links(sets, labels), "more_links")
    if not more.isEmpty():
        labels = connect(links.unionByName(more))
    settled = (reps.join(labels, "member", "left").withColumn("class", F.coalesce("class", "member"))
               .select("d1", "d2", "n", "class", "stays", "copies"))
    classes = settled.groupBy("class").agg(F.min("stays").alias("first"), F.sum("copies").alias("class_size"))
    known = settled.select("d1", "d2", "n", "class").join(classes, "class")
    return narrow.join(known, ["d1", "d2", "n"]).select(
        "row_id", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("row_id") == F.col("first.row_id")).alias("kept"))


def near_dedup_stage(docs: DataFrame) -> DataFrame:
    """One document of each class, all columns as they came."""
    rows, needed = numbered_rows(docs, "near_in", "doc_id", "text")
    keep = near_classes(needed, F.col("row")).filter("kept").select(F.col("row_id").alias("row"))
    return rows.join(keep, "row").select("user.*")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).drop("row_id")
