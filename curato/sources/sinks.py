"""Writers: key/value picks (W34), valid/rejected split (W03), run outputs.

Inputs are never overwritten: every write goes to its own output path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.operators.chunking import assign_chunks, chunks_by_position


def key_value(picks: DataFrame, group: str = "hotel_id") -> DataFrame:
    """W34 shape: key{hotel_id}, value{image_id, cdn_url}."""
    return picks.select(F.struct(F.col(group).alias(group)).alias("key"),
                        F.struct("image_id", "cdn_url").alias("value"))


def write_key_value(picks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the refreshed picks as JSON lines.  Null fields are left out, so
    a pick with no image writes ``"value":{}``."""
    key_value(picks).write.mode(mode).option("lineSep", "\n").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("lineSep", "\n").json(path)


def write_split(checked: DataFrame, path: str, text_col: str = "value", mode: str = "overwrite") -> dict[str, str]:
    """The lines in one pass, so each is checked once: a table of (line,
    reasons) partitioned by ``valid``.  Returns the folder of either half; the
    reasons of a valid line are null."""
    ok = F.size(F.col("violations")) == 0
    (checked.select(F.col(text_col).alias("value"),
                    F.when(~ok, F.array_join(F.col("violations"), ";")).alias("reasons"), ok.alias("valid"))
     .write.mode(mode).partitionBy("valid").option("lineSep", "\n").json(path))
    return {"valid": f"{path}/valid=true", "rejected": f"{path}/valid=false"}


def write_line_chunks(lines: DataFrame, n: int, order, path: str, text_col: str = "value",
                      mode: str = "overwrite") -> None:
    """Write raw lines as n contiguous chunks (``chunk_id=1`` ... folders), in
    ``order``, each holding its lines unchanged; sizes are ceil(N/n), so there
    may be fewer than n."""
    (assign_chunks(lines, n, order).select(text_col, "chunk_id")
     .write.mode(mode).partitionBy("chunk_id").text(path))


def write_file_chunks(lines: DataFrame, n: int, path: str, text_col: str = "value", mode: str = "overwrite") -> None:
    """Write numbered lines as n contiguous chunks in file order.  Positions deal the
    lines evenly over the writers in ranges, so the parts of a chunk, in order of
    their names, are its lines in file order."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (chunks_by_position(lines, n).select(text_col, "chunk_id", "position")
     .repartitionByRange(parts, "position").sortWithinPartitions("chunk_id", "position").drop("position")
     .write.mode(mode).partitionBy("chunk_id").text(path))
