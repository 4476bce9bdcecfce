"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ORDERED = ("variant", "map")


def keep_latest(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], follow: Sequence[str] = ()
) -> DataFrame:
    """The first row of every key in the given order, the remaining columns breaking ties.

    Columns that ``follow`` from the key and the others break no ties and are left out of the order, so a reader that does
    not use them does not have them computed.

    Spark keeps one row per key in each map task before the shuffle (the row-number limit is
    pushed below the exchange), so a hot key sends one row per task, not all of its rows.
    """
    ties = [
        F.col(f.name)
        for f in df.schema.fields
        if f.name not in key and f.name not in follow and not f.dataType.typeName().startswith(_ORDERED)
    ]
    window = Window.partitionBy(*key).orderBy(*order, *ties)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")
