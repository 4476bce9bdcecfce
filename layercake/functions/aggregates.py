"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(column: Column) -> Column:
    """Exact sum over count, as a double. NULL for no values.

    Summing decimals first makes the result independent of the order in which tasks finish.
    """
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def distinct_list(column: Column, sep: str = ", ") -> Column:
    """Sorted distinct values joined to one text, NULL for no values.

    For columns with few labels: the buffer holds the distinct values of a group, not its rows.
    """
    return F.nullif(F.concat_ws(sep, F.array_sort(F.collect_set(column))), F.lit(""))


def det_mode(column: Column) -> Column:
    """Most frequent value, the smallest among equals.

    For columns with few labels; ``operators.grouped_mode`` has no such limit.
    """
    return F.mode(column, True)


def exact_median(column: Column) -> Column:
    """Interpolated median.

    Keeps value counts per group, so use it for price-list-like columns;
    ``operators.grouped_median`` has no such limit.
    """
    return F.percentile(column, F.lit(0.5))
