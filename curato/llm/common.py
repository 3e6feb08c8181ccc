"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.session import stage

# Fixed values of the contracts: the white-space class and the word class.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
HELD_OUT_FOLDS = 5



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a local session find this package wherever they are started;
    # a cluster gets it by --py-files or its image, as usual.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RECORD: list[list[str]] = []


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Collect the paths of the tables staged inside, for a caller that deletes
    them once every result that reads them has been written."""
    _RECORD.append(paths)
    try:
        yield
    finally:
        _RECORD.pop()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under the shared checkpoint folder and read it
    back: a lineage cut that outlives executors, keeps its rows fixed, and
    still lets later steps prune columns."""
    return stage(df, name, _RECORD[-1] if _RECORD else None)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Hand at most ``size`` of Arrow data to a Python worker at once while a table is staged
    inside: a batch of whole texts lies in the JVM and in the worker at the same time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbered_rows(docs: DataFrame, name: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(row, user): each row's number and the row as it came, packed, so that its columns
    meet no name of an operator; and (row, columns) for the operator.  Both read one
    staged table, so the numbers are the same."""
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(
        *[F.col(f"`{c}`") for c in docs.columns]).alias("user")), name)
    return rows, rows.select("row", *[F.col(f"user.{c}") for c in columns])


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as the empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % HELD_OUT_FOLDS == 0


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``bound`` labelled documents of the learning folds, half of them of
    each of the label's two values, as (doc_id, h, label, text), and the number of
    labelled documents of each value.

    A document counts once however often it is labelled (its largest label holds).  Rows
    are picked by a hash of their id, so the choice does not depend on partitioning; ids
    are picked first, so only the picked rows' texts move."""
    lab = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
           .filter(~held_out())
           .withColumn("__h", F.xxhash64(F.lit("fit"), "doc_id")))
    total = {r["__y"]: r["n"] for r in lab.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = max(1, bound // 2)
    picked = None
    for value in (0, 1):
        part = lab.filter(F.col("__y") == value).orderBy("__h", "doc_id").limit(half)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__t"))
            .join(F.broadcast(picked), "doc_id")  # at most ``bound`` rows of two numbers
            .groupBy("doc_id", "__h", "__y").agg(F.min("__t").alias("__t"))
            .select("doc_id", F.col("__h").alias("h"), F.col("__y").alias("label"), F.col("__t").alias("text")))
    return rows, total


def label_weights(labels: np.ndarray, total: dict[int, int]) -> np.ndarray:
    """How many labelled documents of its label each picked row stands for, so that the
    weighted rows have the label's true frequency."""
    share = [total.get(v, 0) / max(1, int((labels == v).sum())) for v in (0, 1)]
    return np.array(share)[labels]


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> list[tuple[bytes, int, float]]:
    """The rows of ``fit_rows`` as (UTF-8 text, label, weight), for a model that learns
    from the texts themselves."""
    picked, total = fit_rows(docs, labels, label, bound)
    rows = picked.orderBy("h", "doc_id").select(F.col("text").cast("binary"), "label").collect()
    weight = label_weights(np.array([y for _, y in rows], dtype=np.int64), total)
    return [(bytes(t), y, float(w)) for (t, y), w in zip(rows, weight, strict=True)]


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end Arrow gives its unused memory back, for the
    worker stays and shares the executor's memory with the next stage."""
    yield from batches
    pa.default_memory_pool().release_unused()


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, offsets) of a string column; a null reads as empty.

    The arrays are views on Arrow's own buffers: no Python strings are made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


SEPARATORS = np.frombuffer(b"\t\n\x0b\x0c\r ", dtype=np.uint8)


def doc_runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of whole documents whose bytes stay within ``limit`` (a longer
    document forms a run of its own)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def pieces(raw: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, offsets) pieces that cover all bytes, none over
    ``limit``: runs of whole documents, and a longer document in parts that end
    after white space (or after ``limit`` bytes where it has none).  Where a
    document is cut depends on its own bytes alone."""
    for a, b in doc_runs(offsets, limit):
        start, end = int(offsets[a]), int(offsets[b])
        if end - start <= limit:
            yield a, raw[start:end], offsets[a:b + 1] - start
            continue
        while start < end:
            stop = min(end, start + limit)
            if stop < end:
                tail = np.flatnonzero(np.isin(raw[max(start, stop - 4096):stop], SEPARATORS))
                if len(tail):
                    stop = max(start, stop - 4096) + int(tail[-1]) + 1
            yield a, raw[start:stop], np.array([0, stop - start], dtype=np.int64)
            start = stop


# -- hashes of words and their beginnings -------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            full = np.full(n, base, dtype=np.uint64)
            full[0] = 1
            _POWERS[name] = np.cumprod(full)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def word_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Byte table for ``Words``: 0 for separators, else one more than the (lower-cased) byte."""
    t = np.arange(1, 257, dtype=np.uint16)
    if lower:
        t[65:91] += 32
    t[np.frombuffer(separators, dtype=np.uint8)] = 0
    return t


class Words:
    """The words of a piece: runs of bytes that the table does not map to 0,
    never across documents, with hashes of the words and of their beginnings."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table_: np.ndarray):
        x = table_[raw]
        inside = x != 0
        before = np.zeros(len(x), dtype=bool)
        before[1:] = inside[:-1]
        cuts = offsets[(offsets > 0) & (offsets < len(x))]
        before[cuts] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(x), dtype=bool)
        after[:-1] = inside[1:]
        after[cuts - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        up, self._down = _powers(len(x) + 1)
        self._sum = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x.astype(np.uint64) * up[:len(x)], out=self._sum[1:])

    def hashes(self, which=slice(None), first: int | None = None) -> np.ndarray:
        """Hash of each chosen word, or of its first ``first`` bytes."""
        start = self.start[which]
        end = self.end[which] if first is None else start + first
        with np.errstate(over="ignore"):
            return mix64((self._sum[end] - self._sum[start]) * self._down[start])
