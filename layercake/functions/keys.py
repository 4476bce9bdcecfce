"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake import rules


def surrogate_key(*columns: Column) -> Column:
    """md5 of the text forms joined by '-', NULL parts replaced by a fixed mark."""
    parts = [F.coalesce(c.cast("string"), F.lit(rules.SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def member_key(key: Column) -> Column:
    """The surrogate key of a known member, that of the unknown one for NULL."""
    return F.when(key.isNotNull(), surrogate_key(key)).otherwise(rules.UNKNOWN_KEY)


def packed_key(key: Column) -> Column:
    """A surrogate key in half its bytes, for shuffles: the 16 bytes that an md5 spells; other texts as they are."""
    return F.when(F.length(key) == 32, F.coalesce(F.unhex(key), key.cast("binary"))).otherwise(key.cast("binary"))


def unpacked_key(packed: Column) -> Column:
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(packed.cast("string"))
