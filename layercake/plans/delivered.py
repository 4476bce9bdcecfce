"""Results in the form in which another engine's results can be compared with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = {
    "l": "bigint", "i": "int", "s": "string", "b": "boolean", "D": "date", "t": "timestamp_ntz",
    "d": "double",
}


def four_places(value: Column) -> Column:
    """Rounded half up, with a nudge that settles ties alike in both engines."""
    return F.floor(value.cast("double") * 10000 + 0.500001) / F.lit(10000.0)


def deliver(df: DataFrame, spec: str) -> DataFrame:
    """The columns of ``"name:kind ..."``; kind ``m`` is a measure rounded to four places."""
    out = []
    for item in spec.split():
        name, kind = item.split(":")
        value = four_places(F.col(name)) if kind == "m" else F.col(name).cast(_KINDS[kind])
        out.append(value.alias(name))
    return df.select(*out)
