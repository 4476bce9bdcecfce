"""Joins to dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    left: Column,
    right: Column,
    key: str,
    unknown: str | int,
    carry: tuple[str, ...] = (),
    spread_by: str | None = None,
    alias: str | None = None,
    member: str | None = None,
) -> DataFrame:
    """Add the dimension's key (and the ``carry`` columns); rows without a match get ``unknown``.

    The join is planned at run time by the dimension's bytes. For large dimensions pass ``spread_by``, a
    column of ``df`` that is well spread: NULL keys, which can match nothing, are then distributed by it
    instead of meeting in one partition. Hot keys that do match are split at run time (adaptive skew
    join), as the dimension has one row each. ``member`` names a column with the dimension's own ``right``, NULL without a match.
    """
    name = alias or key
    side = dim.select(
        right.alias("_right"), F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in carry]
    )
    rows = df.withColumn("_left", left)
    on = F.col("_left") == F.col("_right")
    if spread_by is not None:
        # Zero for every real key on both sides; the hash keeps the optimizer from seeing a
        # constant, which would take the column out of the partitioning.
        rows = rows.withColumn(
            "_spread",
            F.when(F.col("_left").isNull(), F.pmod(F.xxhash64(spread_by), F.lit(4096)))
            .otherwise(F.pmod(F.xxhash64("_left"), F.lit(1))),
        )
        side = side.withColumn("_same", F.pmod(F.xxhash64("_right"), F.lit(1)))
        on = on & (F.col("_spread") == F.col("_same"))
    joined = rows.join(side, on, "left")
    kept = [F.col(c) for c in df.columns if c != name]
    return joined.select(
        *kept,
        F.coalesce(F.col("_key"), F.lit(unknown)).alias(name),
        *[F.col(f"_{c}").alias(c) for c in carry],
        *([F.col("_right").alias(member)] if member else []),
    )


def left_join_where_left(df: DataFrame, other: DataFrame, key: str, where: Column) -> DataFrame:
    """Left join in which only rows of ``df`` that satisfy ``where`` may find a partner.

    The condition belongs to the join: rows that fail it stay, with NULLs from ``other``.
    """
    side = other.withColumnRenamed(key, "_other_key")
    rows = df.withColumn("_may_match", F.when(where, F.col(key)))
    return rows.join(side, F.col("_may_match") == F.col("_other_key"), "left").drop(
        "_may_match", "_other_key"
    )
