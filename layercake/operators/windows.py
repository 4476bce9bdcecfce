"""Ranks, rolling averages, lags and partition averages.

Groups of ``rolling_avg``, ``lag_growth``, ``first_by`` and ``partition_avg`` are sorted or held
by one task each. They are meant for series whose length has a bound, such as one row per calendar
day. Ranks have no such bound; ``rank_by_pieces`` is for groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.functions.numbers import safe_pct
from layercake.operators.slices import SLICE, in_slices, with_rows_before

def rank_by(df: DataFrame, part: Sequence[str], measures: dict[str, str], tiebreak: Sequence[str]) -> DataFrame:
    """Row numbers per group by each measure, largest (and NULL) first.

    ``measures`` maps the rank's name to its measure. One shuffle serves all ranks; a task sorts whole groups
    (on disk where they are large). For groups that outgrow a task there is ``rank_by_pieces``.
    """
    ties = [F.col(c).asc() for c in tiebreak]
    ranks = {
        name: F.row_number().over(Window.partitionBy(*part).orderBy(F.col(measure).desc_nulls_first(), *ties))
        for name, measure in measures.items()
    }
    return df.withColumns(ranks)


def rank_by_pieces(
    df: DataFrame, part: Sequence[str], measure: str, name: str, tiebreak: Sequence[str]
) -> DataFrame:
    """Row number per group, measure descending, NULLs first, for groups of any size.

    All rows are put in one order and cut into slices. The rank is the number of the group's rows in earlier slices
    plus the rank within the slice, so a task sorts one slice of one group at most. Tie-break columns may
    have any type that can be ordered.
    """
    order = [F.col(measure).desc_nulls_first(), *[F.col(c).asc() for c in tiebreak]]
    sliced = in_slices(df, *[F.col(c) for c in part], *order)
    placed = with_rows_before(sliced, part, F.lit(1), "_before")
    within = F.row_number().over(Window.partitionBy(*part, SLICE).orderBy(*order))
    return placed.select(*df.columns, (F.col("_before") + within).cast("int").alias(name))


def rolling_avg(part: Sequence[str], order: str, column: str, rows: int) -> Column:
    """Average of the current row and the ``rows - 1`` before it (rows, not calendar days)."""
    window = Window.partitionBy(*part).orderBy(order).rowsBetween(-(rows - 1), 0)
    return F.avg(column).over(window)


def lag_by(part: Sequence[str], order: str, column: str, rows: int) -> Column:
    """Value ``rows`` rows earlier, NULL where there is none."""
    return F.lag(column, rows).over(Window.partitionBy(*part).orderBy(order))


def lag_growth(now: Column, before: Column) -> Column:
    """Growth in per cent over the earlier value; 0 where that is NULL or not positive."""
    return safe_pct(now - before, before)


def first_by(part: Sequence[str | Column], order: Sequence[Column], column: str) -> Column:
    """Value of the column in the first row of the group."""
    return F.first(column).over(Window.partitionBy(*part).orderBy(*order))


def partition_avg(part: Sequence[str | Column], column: str, where: Column | None = None) -> Column:
    """Average over the whole group, of the rows that meet the condition."""
    value = F.col(column) if where is None else F.when(where, F.col(column))
    return F.avg(value).over(Window.partitionBy(*part))
