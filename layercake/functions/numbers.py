"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(column: Column, default: int, high: int) -> Column:
    """Values above ``high`` become ``high``; non-positive and NULL values become ``default``."""
    return F.when(column > 0, F.least(column, F.lit(high))).otherwise(F.lit(default))


def safe_ratio(num: Column, den: Column, otherwise: Column | float | None = 0.0) -> Column:
    """num / den as a double where den > 0, else ``otherwise``."""
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(rest.cast("double"))


def safe_pct(
    num: Column, den: Column, otherwise: Column | float | None = 0.0, places: int | None = None
) -> Column:
    """num / den * 100 where den > 0, else ``otherwise``.

    ``places`` rounds the percentage; use it where the value meets a limit afterwards, so that an
    exact 70 % does not arrive as 69.99999999999999.
    """
    pct = num.cast("double") / den.cast("double") * 100
    if places is not None:
        pct = F.round(pct, places)
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(den > 0, pct).otherwise(rest.cast("double"))


def strict_cast(column: Column, target: str, on_bad: str = "error") -> Column:
    """Cast that raises on bad text (``error``) or gives NULL (``null``)."""
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")
    return column.cast(target) if on_bad == "error" else column.try_cast(target)
