"""Typed projections of the feeds (W05-W07) and plain enrich joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from curato.session import stage

# Target types of the image record; ``None`` keeps the input type.
IMAGE_TYPES = {
    "image_id": None, "hotel_id": "bigint", "cdn_url": "string", "hash": "string",
    "width": "bigint", "height": "bigint", "created_at": "timestamp", "is_active": "boolean",
}


def images(df: DataFrame) -> DataFrame:
    """The image columns that exist, with bad values made null instead
    of failing the job (``try_cast``)."""
    cols = []
    types = dict(df.dtypes)
    for name, target in IMAGE_TYPES.items():
        if name not in types:
            continue
        c = F.col(name)
        field_type = df.schema[name].dataType
        if target is None:
            cols.append(c)
        elif name == "created_at" and isinstance(field_type, (TimestampType, TimestampNTZType)):
            cols.append(c)
        elif name == "created_at" and isinstance(field_type, StringType):
            cols.append(F.coalesce(F.try_to_timestamp(c), c.try_cast("timestamp")).alias(name))
        else:
            cols.append(c.try_cast(target).alias(name))
    return df.select(*cols)


def flatten_tags(nested: DataFrame, key: str = "image_id") -> DataFrame:
    """One row per (image, tag); empty or null arrays give no row."""
    return (nested.select(key, F.explode("tags").alias("t"))
            .select(key, F.col("t.tag").alias("tag"), F.col("t.version").alias("version"),
                    F.col("t.probability").alias("probability")))


def flatten_picks(nested: DataFrame) -> DataFrame:
    """key{hotel_id}, value{image_id, cdn_url} -> flat columns."""
    return nested.select(F.col("key.hotel_id").alias("hotel_id"),
                         F.col("value.image_id").alias("image_id"),
                         F.col("value.cdn_url").alias("cdn_url"))


def enrich(left: DataFrame, right: DataFrame, key: str | list[str] = "image_id",
           how: str = "left", suffix: str = "_right", stage_left: bool = True,
           tables: list[str] | None = None) -> DataFrame:
    """Equi-join by column name(s); Spark picks the join method.
    Other columns that both sides have get ``suffix`` on the right side.

    A left join that fans out (many right rows per key) is run as an inner
    join plus the left rows without a match: adaptive execution can split a
    hot key of either side of an inner join, but not the right side of a
    left outer join.  The unmatched rows come from an anti join against the
    right side's distinct keys, which partial aggregation shrinks to one row
    per key and map task before the shuffle.  Both joins read the left side,
    so it is staged first; ``stage_left=False`` saves that for a plain scan,
    which gives the same rows twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    mine, keyed = {c.lower() for c in left.columns}, {k.lower() for k in keys}
    right = right.select(*[
        F.col(f"`{c}`").alias(c + suffix if c.lower() in mine and c.lower() not in keyed else c) for c in right.columns])
    if how not in ("left", "left_outer", "leftouter"):
        return left.join(right, keys, how)
    if stage_left:
        left = stage(left, "enrich_left", tables)
    matched = left.join(right, keys, "inner")
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
