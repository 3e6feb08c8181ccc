"""Lifecycle class of an image and the reconciliation flag, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lifecycle classes of an image by its active flag.
INACTIVE = "inactive"
DELETED = "deleted"
OTHER = "other"


def active_flag(col: Column) -> Column:
    """The active flag as a nullable boolean; text that is not a boolean is null."""
    return col.try_cast("boolean")


def lifecycle(is_active: Column) -> Column:
    """'inactive' when the flag is false, 'deleted' when it is null (or the
    image is gone), else 'other'."""
    flag = active_flag(is_active)
    return (F.when(flag == F.lit(False), F.lit(INACTIVE))
            .when(flag.isNull(), F.lit(DELETED))
            .otherwise(F.lit(OTHER)))


def updated_flag(change_type: Column, image_id: Column, new_image_id: Column) -> Column:
    """A pick stays as it is only while its image is live and no other image
    outranks it; without any candidate nothing outranks it.  A pick without a
    class stays too."""
    outranked = F.coalesce(image_id != new_image_id, F.lit(False))
    return F.when(change_type == F.lit(OTHER), outranked).otherwise(change_type.isNotNull())
