"""Exact distinct counts that can be added up: bitmaps of member numbers, merged from period to period.

A bitmap has 4 KB for each 32,768 members that a group may hold, so this is for groups with many members (days,
months), whose bitmaps are kept; groups with a few members are better counted as (group, member) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators.settle import settle

BUCKET, MEMBERS = "_bucket", "_members"


def number_members(df: DataFrame, column: str, name: str = "number") -> DataFrame:
    """(column, number): the distinct values, each with a number of its own; NULL has none.

    Numbers run on within a task's share of the values. They are written once, so they stay what they are.
    """
    members = df.select(column).where(F.col(column).isNotNull()).distinct()
    return settle(members.withColumn(name, F.monotonically_increasing_id()), f"members-{column}")


def member_bitmaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """(by, bucket, bitmap) of the numbers in every group; the tasks that read the rows combine them first."""
    place = F.col(number) + 1
    return (
        df.where(F.col(number).isNotNull()).groupBy(*by, F.bitmap_bucket_number(place).alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(MEMBERS))
    )


def merge_bitmaps(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of larger groups, or of further loads, from those of smaller ones."""
    return parts.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))


def count_members(parts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct members per group, from one bitmap per group and bucket."""
    return parts.groupBy(*by).agg(F.sum(F.bitmap_count(MEMBERS)).alias(name))
