"""Conditional distinct counts, and mode and median without a buffer per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.operators.slices import SLICE, in_slices, with_rows_before


def conditional_counts(
    df: DataFrame,
    by: Sequence[str],
    key: str,
    counts: Mapping[str, Column | None],
    sums: Mapping[str, Column] | None = None,
    key_unique: bool = False,
) -> DataFrame:
    """For every group, the distinct keys that meet each condition, next to plain sums.

    One aggregate on (group, key) reduces each condition to a flag per key, a second one adds the
    flags up. Spark's own plan for several distinct counts would multiply every input row by their
    number. Input already partitioned by the key needs no shuffle for the first step. With
    ``key_unique`` the first step is left out.
    """
    sums = dict(sums or {})
    flags = {
        name: F.when(F.lit(True) if cond is None else cond, 1).otherwise(0)
        for name, cond in counts.items()
    }
    if key_unique:
        present = F.col(key).isNotNull()
        return df.groupBy(*by).agg(
            *[F.sum(F.when(present, f).otherwise(0)).alias(n) for n, f in flags.items()],
            *[F.sum(c).alias(n) for n, c in sums.items()],
        )
    per_key = df.groupBy(*by, key).agg(
        *[F.max(f).alias(n) for n, f in flags.items()],
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )
    present = F.col(key).isNotNull()
    return per_key.groupBy(*by).agg(
        *[F.sum(F.when(present, F.col(n)).otherwise(0)).alias(n) for n in flags],
        *[F.sum(n).alias(n) for n in sums],
    )


def keys_repeat(df: DataFrame, key: str) -> bool:
    """Whether any key stands in more than one row: a count of the keys alone, which nothing else of the rows takes part in."""
    return not df.select(key).where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


def key_flags(
    df: DataFrame, by: Sequence[str], key: str, conditions: Mapping[str, Column | None], unique: bool = False
) -> DataFrame:
    """Add a column per condition whose sum over a group is its number of distinct keys that meet it.

    It is 1 on one row of every (group, key) of which any row meets the condition, else 0, so plain sums
    of all rows and any number of conditional distinct counts share one aggregation. NULL keys count
    for nothing. Rows meet by (group, key), so no task holds more than the rows of one key; where the keys of a group are
    known to be ``unique`` they need not meet at all.
    """
    if unique:
        one = {n: F.lit(True) if condition is None else condition for n, condition in conditions.items()}
        present = F.col(key).isNotNull()
        return df.withColumns({n: F.when(present & condition, 1).otherwise(0) for n, condition in one.items()})
    same = Window.partitionBy(*by, key)
    once = (F.row_number().over(same.orderBy(key)) == 1) & F.col(key).isNotNull()
    flags = {}
    for name, condition in conditions.items():
        any_row = F.lit(1) if condition is None else F.max(F.when(condition, 1).otherwise(0)).over(same)
        flags[name] = F.when(once, any_row).otherwise(0)
    return df.withColumns(flags)


def weighted_mode(value: Column, weight: Column) -> Column:
    """Value with the largest weight, the smallest among equals; each row brings the whole weight of its value."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-weight, value)))


def grouped_mode(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Most frequent value per group, the smallest among equals; NULLs are not counted.

    Two aggregations with map-side combine; no group is ever held in one buffer.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    best = F.min_by(F.col(column), F.struct(-F.col("_n"), F.col(column)))
    return counted.groupBy(*by).agg(best.alias(name))


def grouped_median(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Interpolated median per group, exact, by selection.

    Values are counted first. The counts are cut into slices along their order, and of each group only the slices that
    hold a middle position are looked into. So a hot group is never sorted by one task.
    """
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    )
    sliced = with_rows_before(in_slices(counted, *by, "_v"), by, F.col("_n"), "_below")
    totals = sliced.groupBy(*by, SLICE).agg(F.sum("_n").alias("_here"), F.first("_below").alias("_below"))
    whole = Window.partitionBy(*by)
    middle = (
        totals.withColumn("_all", F.sum("_here").over(whole))
        .withColumn("_lower", F.floor((F.col("_all") - 1) / 2))
        .withColumn("_upper", F.floor(F.col("_all") / 2))
        .where((F.col("_below") + F.col("_here") > F.col("_lower")) & (F.col("_below") <= F.col("_upper")))
    )
    groups = [*by, SLICE]
    side = middle.select(*[F.col(c).alias(f"_of_{c}") for c in groups], "_lower", "_upper")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in groups]
    in_slice = Window.partitionBy(*groups).orderBy("_v")
    placed = sliced.join(side, same).withColumn("_end", F.col("_below") + F.sum("_n").over(in_slice))

    def holds(position: str) -> Column:
        return (F.col("_end") > F.col(position)) & (F.col("_end") - F.col("_n") <= F.col(position))

    value = F.col("_v").cast("double")
    low = F.max(F.when(holds("_lower"), value))
    high = F.max(F.when(holds("_upper"), value))
    return placed.groupBy(*by).agg(((low + high) / 2).alias(name))
