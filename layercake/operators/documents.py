"""Tables of JSON documents: one row per feed with a VARIANT column.

A document holds a section of settings and a list of items, for example
``{"project_config": {...}, "tasks": [{"name": ..., "enabled": ..., "depends_on": [...]}, ...]}``.
Lists are handled inside their row; a row is one document, so its size is that of one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.operators.dedupe import keep_latest


def feed_name_of(file_name: Column) -> Column:
    """Base name without its last extension; a name that only starts with a dot stays whole."""
    base = F.regexp_extract(file_name, r"([^/]+)$", 1)
    stem = F.regexp_extract(base, r"^(.+)\.[^.]*$", 1)
    return F.coalesce(F.nullif(stem, F.lit("")), base)


def load_json_docs(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    """(feed_name, config_data, loaded_at) for every JSON file of a folder."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        feed_name_of(F.col("_metadata.file_name")).alias("feed_name"),
        F.parse_json("value").alias("config_data"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
    )


def replace_docs(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Documents of feeds that do not arrive again, and the incoming ones."""
    kept = existing.join(incoming.select("feed_name"), "feed_name", "left_anti")
    return kept.select(*incoming.columns).unionByName(incoming)


def items_of(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "array<variant>")


def explode_items(df: DataFrame, document: str, path: str, keep: Sequence[str]) -> DataFrame:
    """One row per list item: the kept columns, its ``index`` and its ``value``."""
    return df.select(*keep, F.posexplode(items_of(F.col(document), path)).alias("index", "value"))


def item_enabled(item: Column) -> Column:
    """The item's flag; an item without one is enabled."""
    return F.coalesce(F.try_variant_get(item, "$.enabled", "boolean"), F.lit(True))


def feed_items(docs: DataFrame, feed: str | None = None, ordered: bool = False) -> DataFrame:
    """The tasks of one feed, or of all; ``ordered`` sorts the listing by feed and place in the document."""
    if ordered:
        return feed_items(docs, feed).orderBy("feed_name", "index")
    if feed is not None:
        docs = docs.where(F.col("feed_name") == feed)
    item = F.col("value")
    return explode_items(docs, "config_data", "$.tasks", ["feed_name"]).select(
        "feed_name",
        "index",
        F.variant_get(item, "$.name", "string").alias("task_name"),
        item_enabled(item).alias("enabled"),
        F.variant_get(item, "$.dbt_command", "string").alias("dbt_command"),
        F.variant_get(item, "$.schedule", "string").alias("schedule"),
        F.try_variant_get(item, "$.depends_on", "array<string>").alias("depends_on"),
    )


def feed_summary(docs: DataFrame, ordered: bool = False) -> DataFrame:
    """Tasks, enabled tasks and disabled tasks per document; documents without tasks drop out.

    ``ordered`` sorts the listing by loading time, newest first.
    """
    if ordered:
        return feed_summary(docs).orderBy(F.col("loaded_at").desc(), "feed_name")
    items = items_of(F.col("config_data"), "$.tasks")
    on = F.col("enabled")
    return (
        docs.select(
            "feed_name",
            "loaded_at",
            F.size(items).alias("total_tasks"),
            F.explode(F.transform(items, item_enabled)).alias("enabled"),
        )
        .groupBy("feed_name", "loaded_at", "total_tasks")
        .agg(
            F.sum(F.when(on, 1).otherwise(0)).alias("enabled_tasks"),
            F.sum(F.when(~on, 1).otherwise(0)).alias("disabled_tasks"),
        )
    )


def validate_document(
    docs: DataFrame,
    section: str = "project_config",
    fields: Sequence[str] = ("database", "schema", "project_name"),
    items: str = "tasks",
    item_fields: Sequence[str] = ("name", "dbt_command"),
) -> DataFrame:
    """(feed_name, is_valid, message) of the latest document of every feed; first fault wins."""
    latest = keep_latest(docs, ["feed_name"], [F.col("loaded_at").desc()])
    document = F.col("config_data")
    feed = F.concat(F.lit(" for feed: "), F.col("feed_name"))
    listed = items_of(document, f"$.{items}")

    def lacks(value: Column, path: str) -> Column:
        return F.try_variant_get(value, path, "string").isNull()

    def item_fault(item: Column, position: Column) -> Column:
        number = (position + 1).cast("string")
        fault = F.lit(None).cast("string")
        for name in reversed(item_fields):
            text = F.concat(F.lit("Error: Task "), number, F.lit(f" is missing {name} field"), feed)
            fault = F.when(lacks(item, f"$.{name}"), text).otherwise(fault)
        return fault

    message = (
        F.when(
            document.isNull(),
            F.concat(F.lit("Error: No configuration found"), feed, F.lit(". Please load a JSON file first.")),
        )
        .when(
            F.try_variant_get(document, f"$.{section}", "variant").isNull(),
            F.concat(F.lit(f"Error: Missing {section} section"), feed),
        )
    )
    for name in fields:
        message = message.when(
            lacks(document, f"$.{section}.{name}"),
            F.concat(F.lit(f"Error: Missing required field: {section}.{name}"), feed),
        )
    message = message.when(
        listed.isNull() | (F.size(listed) == 0),
        F.concat(F.lit(f"Error: Missing or empty {items} array"), feed),
    )
    faults = F.filter(F.transform(listed, item_fault), lambda text: text.isNotNull())
    message = F.coalesce(message, F.get(faults, F.lit(0)))
    valid = F.concat(F.lit("Configuration is valid"), feed)
    return latest.select(
        "feed_name",
        message.isNull().alias("is_valid"),
        F.coalesce(message, valid).alias("message"),
    )


def dependency_filter(docs: DataFrame) -> DataFrame:
    """Enabled tasks with those of their dependencies that are themselves enabled.

    A dependency that names no task of the document is dropped too.
    """
    task = "array<struct<name:string,enabled:boolean,depends_on:array<string>>>"
    tasks = F.try_variant_get(F.col("config_data"), "$.tasks", task)
    rows = docs.select("feed_name", tasks.alias("_tasks"))
    one = F.col("_task")

    def is_enabled(name: Column) -> Column:
        named = F.get(F.filter("_tasks", lambda t: t["name"] == name), F.lit(0))
        return named.isNotNull() & F.coalesce(named["enabled"], F.lit(True))

    return (
        rows.select("feed_name", "_tasks", F.posexplode("_tasks").alias("index", "_task"))
        .where(F.coalesce(one["enabled"], F.lit(True)))
        .select(
            "feed_name",
            "index",
            one["name"].alias("task_name"),
            F.filter(F.coalesce(one["depends_on"], F.array().cast("array<string>")), is_enabled)
            .alias("depends_on"),
        )
    )
