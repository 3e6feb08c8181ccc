"""Default record contracts of the three feeds, and typed extraction.

The original's JSON-Schema files are not shipped; these contracts are
reconstructed from the fields the job reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curato.functions.contract import Contract, Rule
from curato.operators.shape import flatten_tags

IMAGE_CONTRACT = Contract(name="images", rules=(
    Rule("image_id", type="string", required=True, min_length=1),
    Rule("hotel_id", type="integer", required=True),
    Rule("cdn_url", type="string", nullable=True),
    Rule("hash", type="string", nullable=True),
    Rule("width", type="integer", nullable=True, minimum=0),
    Rule("height", type="integer", nullable=True, minimum=0),
    Rule("created_at", type="string", nullable=True),
    Rule("is_active", type="boolean", nullable=True),
), additional=True)

TAG_ITEM = Rule("tag", type="object", properties=(
    Rule("tag", type="string", required=True),
    Rule("version", type="string", nullable=True),
    Rule("probability", type="number", nullable=True, minimum=0, maximum=1),
))

TAGS_CONTRACT = Contract(name="image_tags", rules=(
    Rule("image_id", type="string", required=True, min_length=1),
    Rule("tags", type="array", required=True, items=TAG_ITEM),
), additional=True)

PICKS_CONTRACT = Contract(name="main_images", rules=(
    Rule("key", type="object", required=True, properties=(
        Rule("hotel_id", type="integer", required=True),)),
    Rule("value", type="object", required=True, properties=(
        Rule("image_id", type="string", nullable=True),
        Rule("cdn_url", type="string", nullable=True))),
), additional=True)


def _get(path: str, t: str):
    return F.try_variant_get(F.col("record"), path, t)


def image_fields() -> dict:
    """Typed columns of an image line (one per line)."""
    created = _get("$.created_at", "string")
    return {
        "image_id": _get("$.image_id", "string"),
        "hotel_id": _get("$.hotel_id", "bigint"),
        "cdn_url": _get("$.cdn_url", "string"),
        "hash": _get("$.hash", "string"),
        "width": _get("$.width", "bigint"),
        "height": _get("$.height", "bigint"),
        "created_at": F.coalesce(F.try_to_timestamp(created), created.try_cast("timestamp")),
        "is_active": _get("$.is_active", "boolean"),
    }


def tag_fields() -> dict:
    """Typed columns of a tags line, still nested (one row per line)."""
    return {"image_id": _get("$.image_id", "string"),
            "tags": _get("$.tags", "array<struct<tag:string,version:string,probability:double>>")}


def pick_fields() -> dict:
    return {"hotel_id": _get("$.key.hotel_id", "bigint"),
            "image_id": _get("$.value.image_id", "string"),
            "cdn_url": _get("$.value.cdn_url", "string")}


def _same(df: DataFrame) -> DataFrame:
    return df


# Feed name -> (contract, typed columns of a line, step after reading them back).
FEEDS = {
    "images": (IMAGE_CONTRACT, image_fields, _same),
    "image_tags": (TAGS_CONTRACT, tag_fields, flatten_tags),
    "main_images": (PICKS_CONTRACT, pick_fields, _same),
}
