"""Readers of raw files and declared sources, and the freshness check."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from layercake.operators.settle import settle
from layercake.sources.footers import stored_max
from layercake.sources.schemas import JSON_COLUMNS, RAW_SCHEMAS, SOURCES


def read_raw(spark: SparkSession, table: str, path: str, **options: str) -> DataFrame:
    """Delimited files without header, one or a whole folder tree, in the declared schema.

    A row that does not fit the schema fails the load. ``options`` go to the CSV reader.
    """
    df = (
        spark.read.schema(RAW_SCHEMAS[table])
        .options(mode="FAILFAST", escape='"', recursiveFileLookup="true")
        .options(**options)
        .csv(path)
    )
    documents = {c: F.parse_json(F.col(c)) for c in JSON_COLUMNS.get(table, [])}
    return df.withColumns(documents) if documents else df


class BadRows(ValueError):
    """A load has more rows that do not fit the schema than it may have."""


def load_raw(
    spark: SparkSession, table: str, path: str, most_bad: int = 0, **options: str
) -> tuple[DataFrame, DataFrame]:
    """``read_raw`` that keeps rows which do not fit beside the others: (rows, bad rows).

    Files are read once, into the shared folder; that pass counts the bad rows and finds the first. Bad rows have
    ``file`` and ``row``, the text as it came. More of them than ``most_bad`` raise, with the first row and its file.
    """
    documents = JSON_COLUMNS.get(table, [])
    parsed = (
        spark.read.schema(StructType([*RAW_SCHEMAS[table], StructField("row", StringType())]))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord="row", escape='"', recursiveFileLookup="true")
        .options(**options).csv(path).withColumn("file", F.col("_metadata.file_path"))
    )
    # A document that does not parse makes its row a bad one; fields that are NULL in a bad row do not count.
    broken = [F.col(c).isNotNull() & F.try_parse_json(c).isNull() for c in documents]
    bad = F.col("row").isNotNull() | reduce(lambda a, b: a | b, broken, F.lit(False))
    as_text = F.coalesce("row", F.concat_ws(",", *[F.col(name).cast("string") for name in RAW_SCHEMAS[table].names]))
    seen = Observation(f"rows of {table}")
    where = F.struct("file", as_text.alias("row"))
    marked = parsed.withColumn("_bad", bad).observe(
        seen, F.count_if("_bad").alias("bad"), F.min(F.when(F.col("_bad"), where)).alias("first")
    )
    held = settle(marked.withColumn("row", F.when(F.col("_bad"), as_text)), f"load-{table}")
    counted = seen.get
    if counted["bad"] > most_bad:
        raise BadRows(f"{counted['bad']} rows do not fit {table}, first in {counted['first'].file}: {counted['first'].row}")
    good = held.where(~F.col("_bad")).drop("row", "file", "_bad")
    return good.withColumns({c: F.parse_json(F.col(c)) for c in documents}), held.where("_bad").select("file", "row")


def source(spark: SparkSession, group: str, table: str, base: str | None = None) -> DataFrame:
    """A declared source by name: a catalog table, or parquet below ``base/group/table``."""
    declared = SOURCES.get(table)
    if declared is None or declared.group != group:
        raise KeyError(f"{group}.{table} is not a declared source")
    return spark.table(f"{group}.{table}") if base is None else spark.read.parquet(f"{base}/{group}/{table}")


def freshness(
    df: DataFrame, column: str, warn_hours: int, error_hours: int, as_of: datetime | Column, stored: bool = False
) -> DataFrame:
    """One row (loaded_at, age_hours, status): ``pass``, ``warn`` or ``error`` by the newest value.

    An empty table has no newest value and is an error. With ``stored``, ``df`` is a table as it was written, and its
    newest value comes from the footers of its files, when this is called.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    if stored:
        newest = df.sparkSession.range(1).select(
            F.lit(stored_max(df, column)).cast(df.schema[column].dataType).cast("timestamp").alias("loaded_at")
        )
    else:
        newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("loaded_at"))
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp("loaded_at")) / F.lit(3600.0)
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


def declared_freshness(tables: Mapping[str, DataFrame], as_of: datetime | Column) -> DataFrame:
    """(source, loaded_at, age_hours, status) of every source that declares a loading time, by its own limits."""
    checked = [
        freshness(tables[name], declared.loaded_at, declared.warn_hours, declared.error_hours, as_of)
        .select(F.lit(name).alias("source"), "*")
        for name, declared in SOURCES.items()
        if declared.loaded_at is not None and declared.error_hours is not None and name in tables
    ]
    return reduce(DataFrame.unionByName, checked)
