"""Marts that grow by days: facts are added up again from the first changed day on, never those before it.

The totals per day are a table of their own, in months. What a mart adds to them (attributes, ranks, averages over rows,
months or seasons) may change for any day, and is made from the totals, which are small beside the facts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators.incremental import read_upserted, replace_table
from layercake.operators.settle import settle
from layercake.plans import analytics
from layercake.plans.build import Layers
from layercake.sources import catalog


@dataclass(frozen=True)
class Growing:
    """``totals`` of the facts and tables it takes (orders among them), and the mart ``of`` totals and dimensions."""

    totals: Callable[..., DataFrame]
    facts: tuple[str, ...]
    of: Callable[..., DataFrame]
    dimensions: tuple[str, ...]
    columns: tuple[str, ...]  # what the totals take of the orders


_PLACED = (
    "order_id", "order_timestamp", "order_date_sk", "truck_sk", "customer_sk", "order_channel", "meal_period",
)
GROWING = {
    "agg_daily_sales": Growing(
        analytics.daily_sales_totals, ("fact_order",), analytics.daily_sales_of, ("dim_date", "dim_truck", "dim_location"),
        (*_PLACED, "location_sk", "discount_percentage", "order_total", "total_cost_of_goods", "order_profit",
         "processing_time_minutes", "line_item_count", "total_items_ordered"),
    ),
    "agg_location_insights": Growing(
        analytics.location_totals, ("fact_order",), analytics.location_insights_of, ("dim_date", "dim_location"),
        (*_PLACED, "location_sk", "order_hour", "order_total", "processing_time_minutes"),
    ),
    "agg_menu_performance": Growing(
        analytics.menu_item_totals, ("order_lines", "order_heads", "dim_truck"), analytics.menu_performance_of,
        ("dim_date", "dim_menu_item"), _PLACED,
    ),
}


def first_changed_day(new_facts: DataFrame) -> date | None:
    """The earliest day of orders that came or changed; None if there are none."""
    key = new_facts.agg(F.min("order_date_sk")).first()[0]
    return None if key is None or key < 0 else date(key // 10000, key // 100 % 100, key % 100)


def totals_target(target: str) -> str:
    return f"{target}/totals" if "/" in target else f"{target}_totals"


def refresh_totals(layers: Layers, name: str, target: str, since: date | None) -> DataFrame:
    """The totals of a mart, kept in ``target``: those of days from ``since`` on are computed and their months written."""
    spark, mart, part = layers.spark, GROWING[name], F.floor(F.col("order_date_sk") / 100).cast("int")
    version = catalog.newest(spark, target) if since else None
    columns = mart.totals(*[layers[table] for table in mart.facts], layers.run).columns
    if version and set(columns) != set(catalog.rows(spark, version).columns) - {"_part"}:
        # Kept by other keys, as facts with and without ids give them: all days are added up anew.
        version = None
    # The key of a day is its digits, so the filter reaches the scan of the facts.
    first = int(f"{since:%Y%m%d}") if version else None

    def fact(table: str) -> DataFrame:
        rows = layers[table]
        return rows.where(F.col("order_date_sk") >= first) if first and table in ("fact_order", "order_heads") else rows

    fresh = mart.totals(*[fact(table) for table in mart.facts], layers.run).withColumn("_part", part)
    if version is None:
        replace_table(fresh, target, "_part")
    else:
        fresh, before = settle(fresh, name), catalog.rows(spark, version).where(F.col("_part") >= first // 100)
        # As many names as there are months from that day on.
        parts = before.select("_part").union(fresh.select("_part")).distinct()
        touched = {row[0] for row in parts.select(catalog.folder_of(F.col("_part"))).collect()}
        kept = before.where(F.col("order_date_sk") < first)
        catalog.commit(kept.unionByName(fresh), target, "_part", version, touched)
    return read_upserted(spark, target).drop("_part")


def refresh_mart(layers: Layers, name: str, target: str, since: date | None = None) -> DataFrame:
    """Bring the mart in ``target``, a name or a folder, up to date and return it.

    ``layers`` holds all facts; without ``since``, or where the mart is not there yet, all of them are read.
    """
    mart = GROWING[name]
    totals = refresh_totals(layers, name, totals_target(target), since)
    place = f"{target}/mart" if "/" in target else target
    replace_table(mart.of(totals, *[layers[d] for d in mart.dimensions], layers.run), place)
    return read_upserted(layers.spark, place)
