"""Values inside JSON documents held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_variant(df: DataFrame, column: str) -> Column:
    """The column as VARIANT; JSON text is parsed (bad JSON raises, as in a typed load)."""
    if df.schema[column].dataType.typeName() == "string":
        return F.parse_json(F.col(column))
    return F.col(column)


def variant_field(value: Column, path: str, target: str, on_bad: str = "error") -> Column:
    """A field cast to ``target``; NULL where it is absent. ``on_bad='null'`` forgives bad values."""
    get = F.variant_get if on_bad == "error" else F.try_variant_get
    return get(value, path, target)


def variant_flag(value: Column, path: str) -> Column:
    """TRUE for the boolean true and for the text 'true'; anything else, and absence, is FALSE."""
    return F.coalesce(F.try_variant_get(value, path, "string") == "true", F.lit(False))
