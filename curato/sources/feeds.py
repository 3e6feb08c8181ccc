"""Readers for the JSON-lines feeds (images, tags, picks).

``read_lines`` is the contract-checked path: the text is scanned as lines and
parsed on the executors (no driver-side list, no schema inference).
``read_typed`` is the plain typed scan with an explicit schema.
Paths may be files, directories or globs; ``glob`` filters file names inside
a directory (e.g. ``"*.jsonl"``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DecimalType, DoubleType, LongType, NullType,
                               StringType, StructField, StructType, TimestampType, VariantType,
                               _parse_datatype_string)

from curato.functions import paths
from curato.session import stage

IMAGES_SCHEMA = StructType([
    StructField("image_id", StringType()),
    StructField("hotel_id", LongType()),
    StructField("cdn_url", StringType()),
    StructField("hash", StringType()),
    StructField("width", LongType()),
    StructField("height", LongType()),
    StructField("created_at", TimestampType()),
    StructField("is_active", BooleanType()),
])

TAG_SCHEMA = StructType([
    StructField("tag", StringType()),
    StructField("version", StringType()),
    StructField("probability", DoubleType()),
])

NESTED_TAGS_SCHEMA = StructType([
    StructField("image_id", StringType()),
    StructField("tags", ArrayType(TAG_SCHEMA)),
])

def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Raw lines (``value`` string) of one or more JSONL files."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path)


#: Splits whose first line numbers are sent to every task; beyond, the join is left to the planner.
MAX_SPLITS = 200_000


def read_split_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Raw lines with the split each was read from: ``file``, ``block`` (the split's first
    byte) and ``seq``, a number that rises by one along a split.

    The splits depend on the executors at hand, so this must be staged before lines
    are counted: ``split_starts`` and ``with_places`` take the staged table."""
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return read_lines(spark, path, glob).select("value", *split).withColumn("seq", F.monotonically_increasing_id())


def split_starts(staged: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """One row per split of staged lines (none left out): how many lines come before it."""
    splits = staged.groupBy("file", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_all = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)     # one row per split
    return stage(splits.select("file", "block", "first", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("before"),
                               F.coalesce(F.sum("n").over(in_all), F.lit(0)).alias("all_before")), "splits", tables)


def with_places(staged: DataFrame, starts: DataFrame) -> DataFrame:
    """Staged lines with ``line`` (from 1, within the file) and ``position`` (from 0,
    over all files in order of their paths) in place of ``block`` and ``seq``."""
    side = F.broadcast(starts) if starts.count() <= MAX_SPLITS else starts
    at = F.col("seq") - F.col("first")
    return (staged.join(side, ["file", "block"])
            .withColumns({"line": F.col("before") + at + 1, "position": F.col("all_before") + at})
            .drop("block", "seq", "first", "before", "all_before"))


@contextmanager
def _split_size(spark: SparkSession, size: str, tasks: int) -> Iterator[None]:
    """Read in splits of at most ``size``, several to a task where there would be more than ``tasks``."""
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": str(tasks)}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def number_lines(spark: SparkSession, path: str | list[str], glob: str | None = None,
                 tables: list[str] | None = None, split_size: str | None = None) -> DataFrame:
    """Lines with their places: ``file``, ``value``, ``line``, ``position``.

    A scan carries no line numbers, but it reads a split in order.  The lines are
    staged once with their split and a running number, and counts per split, summed
    over the splits before it, turn these into line numbers.  No line is sorted or
    shuffled: only one row per split is.  Blank lines count.

    ``split_size`` reads the files, and nothing else, in splits of at most that size; the
    tasks stay as many as the reader would have had without it."""
    lines = read_split_lines(spark, path, glob)
    if split_size is None:
        lines = stage(lines, "lines", tables)
    else:
        with _split_size(spark, split_size, max(1, lines.rdd.getNumPartitions())):
            lines = stage(lines, "lines", tables)
    return with_places(lines, split_starts(lines, tables))


def read_typed(spark: SparkSession, path: str | list[str], schema: StructType,
               glob: str | None = None) -> DataFrame:
    """Typed JSONL scan with an explicit schema; values of the wrong type
    become null (use the contract path to reject them instead)."""
    reader = spark.read.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


def read_chunk_dir(spark: SparkSession, directory: str, schema: StructType, glob: str = "{*.jsonl,part-*}",
                   chunk_col: str = "chunk_id") -> DataFrame:
    """Typed rows of every matching file in ``directory``, each tagged with its
    chunk as ``chunk_col`` (for ``chunking.join_chunks``): the partition folder
    ``chunk_id=...`` that the chunk sink writes, so a chunk of several files is
    one chunk, or the file's name in a flat directory.  ``glob`` takes JSONL
    files and Spark's own part files."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/chunk_id=([^/]*)/", 1)
    return reader.json(directory).withColumn(
        chunk_col, F.when(folder != "", folder).otherwise(F.col("_metadata.file_name")))


@dataclass(frozen=True)
class Inferred:
    """A scan whose types were found in its lines."""

    rows: DataFrame              # typed columns
    schema: StructType
    conflicts: DataFrame         # (path, kind, n): what was met where kinds do not agree
    malformed: DataFrame         # lines that are no JSON object, as they are


def _settled(t: DataType, path: str, conflicts: list[str]) -> DataType:
    """Column types of the kinds found: any number with a fraction is a double, what
    is always null or of several kinds is text."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _settled(f.dataType, path + paths.field(f.name), conflicts)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_settled(t.elementType, f"{path}[]", conflicts))
    if isinstance(t, VariantType):
        conflicts.append(path)
    if isinstance(t, (VariantType, NullType)):
        return StringType()
    if isinstance(t, DecimalType):
        return LongType() if t.scale == 0 and t.precision <= 18 else DoubleType()
    return t


def _values(record: Column, path: str) -> Column:
    """All values at a path of field names and ``[]``, as an array of VARIANTs."""
    here, *rest = path.split("[]")
    found = F.array(F.try_variant_get(record, here, "variant"))
    for step in rest:
        items = F.flatten(F.transform(found, lambda v: F.coalesce(
            F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))))
        found = _step(items, step) if step else items
    return found


def _step(items: Column, step: str) -> Column:
    return F.transform(items, lambda v: F.try_variant_get(v, f"${step}", "variant"))


def infer_scan(spark: SparkSession, path: str | list[str], glob: str | None = None,
               tables: list[str] | None = None) -> Inferred:
    """JSON lines as typed columns, with the types that the lines have.

    Each line is parsed once, to a staged VARIANT.  The kinds of all lines are merged by
    one aggregate that is combined before its shuffle (a field's kind is the least
    one that holds what every line has there), and the staged values are read with
    the result.  Whole numbers are bigint, and double where some line has a
    fraction; a field that is always null is text; a field of several
    kinds is text too and its kinds are listed by path.  Blank lines are skipped.  An
    empty input gives an empty relation without columns."""
    lines = read_lines(spark, path, glob).filter(F.col("value").rlike(r"\S"))
    parsed = stage(lines.withColumn("record", F.try_parse_json("value")).withColumn(
        "is_object", F.coalesce(F.try_variant_get("record", "$", "map<string,variant>").isNotNull(), F.lit(False)))
        .select(F.when(F.col("is_object"), F.col("record")).alias("record"),
                F.when(~F.col("is_object"), F.col("value")).alias("value"), "is_object"), "inferred", tables)
    records = parsed.filter("is_object").select("record")
    merged = records.agg(F.schema_of_variant_agg("record").alias("s")).first()["s"]
    # In names, which are quoted, nothing is replaced.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m.group(1) or "STRUCT<", merged or "VOID")
    found = _parse_datatype_string(ddl) if ddl.startswith("STRUCT<") else StructType([])
    conflicts: list[str] = []
    schema = _settled(found, "$", conflicts)
    rows = records.select(*[F.try_variant_get("record", "$" + paths.field(f.name), f.dataType.simpleString()).alias(f.name)
                            for f in schema.fields])
    kinds = records.select(F.explode(F.array(*[F.struct(F.lit(p).alias("path"), _values(F.col("record"), p).alias("found"))
                                               for p in conflicts]))).select("col.path", F.explode("col.found").alias("v")) \
        if conflicts else spark.createDataFrame([], "path string, v string").withColumn("v", F.lit(None).cast("variant"))
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    report = (kinds.filter(F.col("v").isNotNull()).select("path", kind.alias("kind"))
              .groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")))
    return Inferred(rows, schema, report, parsed.filter("not is_object").select("value"))
