"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.operators.settle import settle

__all__ = ["ascii_lower", "broadcast_within", "light_batches", "settle", "table"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows in one Arrow batch: texts may be long, so a batch is kept to some tens of MB.
BATCH_ROWS = 512


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays (``lower`` would change accented letters too)."""
    return F.translate(text, _UPPER, _LOWER)


def light_batches(spark: SparkSession) -> None:
    """Keep the batches that Python workers get small enough for tables with very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


# Tables are broadcast up to this size; larger ones are joined by shuffle.
BROADCAST_BYTES = 64_000_000


def broadcast_within(rows: DataFrame, bytes_per_row: int) -> DataFrame:
    """``rows`` (written before, so that counting is cheap), marked for broadcast if their counted size allows."""
    return F.broadcast(rows) if rows.count() * bytes_per_row <= BROADCAST_BYTES else rows
