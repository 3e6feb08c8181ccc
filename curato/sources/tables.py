"""The selection inputs as views over the driver's parquet tables.

Candidate = order, group ("hotel") = the order's customer, tag = line item.
Only the columns a view needs are read, so the parquet scans prune to them.
The derivations are fixed test definitions (see FIXTURES.md) and must agree
with the SQL in ``curato.oracle`` row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curato.operators.ranking import rank_in_group

# The url prefix of the image views and the offset of
# current picks that point at images which no longer exist.
CDN_PREFIX = "https://cdn.example.com/"
MISSING_IMAGE_BASE = 10000000


# Declared schemas of the driver tables the views read: a scan with a
# declared schema needs no footer-reading job to infer one.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def images_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, hotel_id, width, height, created_at, is_active, cdn_url."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("image_id"),
        F.col("o_custkey").alias("hotel_id"),
        F.when(k % 97 == 0, F.lit(0)).when(k % 89 == 0, F.lit(None))
        .otherwise(1 + (k * 7919) % 4000).cast("long").alias("width"),
        F.when(k % 101 == 0, F.lit(0)).otherwise(1 + (k * 104729) % 3000).cast("long").alias("height"),
        F.when(k % 83 == 0, F.lit(None))
        .when(k % 79 == 0, F.col("o_orderdate") + F.expr("INTERVAL 10 YEARS"))
        .otherwise(F.col("o_orderdate")).alias("created_at"),
        F.when((F.col("o_orderstatus") == "P") | (F.col("o_custkey") % 50 == 0), F.lit(False))
        .when((F.col("o_orderstatus") == "O") & (k % 10 == 0), F.lit(None))
        .otherwise(F.lit(True)).cast("boolean").alias("is_active"),
        F.concat(F.lit(CDN_PREFIX), k.cast("string")).alias("cdn_url"),
    )


def tags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat tags: image_id, tag, version, probability."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_discount")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        F.concat("l_returnflag", "l_linestatus").alias("tag"),
        F.col("l_linenumber").cast("string").alias("version"),
        F.round(F.col("l_discount") * 10, 6).alias("probability"),
    )


def picks_view(spark: SparkSession, sf_dir: str, images: DataFrame | None = None) -> DataFrame:
    """Current picks (hotel_id, image_id, cdn_url): for each hotel not a
    multiple of 13, its (1 + hotel_id mod n)-th image by id; every 11th hotel
    points at an image id that does not exist."""
    images = images if images is not None else images_view(spark, sf_dir)
    ranked = rank_in_group(images.select("image_id", "hotel_id"), ["hotel_id"],
                           [F.col("image_id").asc_nulls_last()], rank_col="rn", size_col="n")
    h = F.col("hotel_id")
    return (ranked
            .filter((F.col("rn") == 1 + h % F.col("n")) & (h % 13 != 0))
            .select(
                h,
                F.when(h % 11 == 0, F.lit(MISSING_IMAGE_BASE) + h).otherwise(F.col("image_id"))
                .alias("image_id"),
                F.concat(F.lit(CDN_PREFIX), F.col("image_id").cast("string")).alias("cdn_url")))


def nested_tags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested tag feed shape (image_id, tags array<struct>), one record
    per line item, built per row: by line number and quantity the array is
    null, empty, or holds one to three tags (the j-th with version
    ``<line>.<j>`` and the probability lowered by j tenths, at least 0; the
    third has no probability)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_quantity")

    def tag(j: int):
        p = F.lit(None).cast("double") if j == 2 else F.greatest(F.round(F.col("l_discount") * 10 - j / 10, 6), F.lit(0.0))
        return F.struct(F.concat("l_returnflag", "l_linestatus").alias("tag"),
                        F.concat_ws(".", F.col("l_linenumber").cast("string"), F.lit(str(j))).alias("version"),
                        p.alias("probability"))

    n = (F.col("l_linenumber") + F.col("l_quantity").cast("int")) % 5
    kind = "array<struct<tag:string,version:string,probability:double>>"
    tags = (F.when(n == 0, F.lit(None).cast(kind)).when(n == 1, F.array().cast(kind))
            .when(n == 2, F.array(tag(0))).when(n == 3, F.array(tag(0), tag(1))).otherwise(F.array(tag(0), tag(1), tag(2))))
    return li.select(F.col("l_orderkey").alias("image_id"), tags.alias("tags"))


def repeated_images_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image feed with repeated ids: every third image comes again a year
    older, every fifth without a date, every seventh unchanged but for a
    larger url."""
    images = images_view(spark, sf_dir)
    k = F.col("image_id")
    older = images.filter(k % 3 == 0).withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 1 YEAR"))
    undated = images.filter(k % 5 == 0).withColumn("created_at", F.lit(None).cast(images.schema["created_at"].dataType))
    again = images.filter(k % 7 == 0).withColumn("cdn_url", F.concat("cdn_url", F.lit("?again")))
    return images.unionByName(older).unionByName(undated).unionByName(again)


def text_images_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image feed as text, some values bad: sizes that are no numbers,
    flags that are no booleans, dates that no calendar has."""
    images = images_view(spark, sf_dir)
    k = F.col("image_id")
    return images.select(
        k.cast("string").alias("image_id"), F.col("hotel_id").cast("string").alias("hotel_id"), "cdn_url",
        F.when(k % 11 == 0, F.lit("wide")).otherwise(F.col("width").cast("string")).alias("width"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.col("height").cast("string")).alias("height"),
        F.when(k % 17 == 0, F.lit("2005-13-45 00:00:00")).when(k % 19 == 0, F.lit("soon"))
        .otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.when(k % 23 == 0, F.lit("maybe")).when(k % 29 == 0, F.lit("TRUE"))
        .otherwise(F.col("is_active").cast("string")).alias("is_active"))


def nested_picks_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key/value pick feed shape: key{hotel_id}, value{image_id, cdn_url}."""
    return picks_view(spark, sf_dir).select(
        F.struct("hotel_id").alias("key"),
        F.struct("image_id", "cdn_url").alias("value"))
