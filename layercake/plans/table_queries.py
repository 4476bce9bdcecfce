"""Queries that show tables at work: loads, catalog, builds with gates, marks, increments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake import operators as ops
from layercake.operators.incremental import new_rows
from layercake.plans.build import GateFailed, Layers, build
from layercake.plans.increments import GROWING, first_changed_day, refresh_mart
from layercake.plans.operator_queries import CALENDAR, ORDER_COLUMNS, RUN, documents, layers, table
from layercake.plans.run import Run
from layercake.quality.checks import RESULT
from layercake.session import prepare, shared_dir
from layercake.sources import catalog, freshness, load_note, load_raw, raw_tables
from layercake.sources.schemas import RAW_SCHEMAS
from layercake.sources.sinks import catalog_view, table_exists, write_table

c = F.col
EARLY = Run(RUN.as_of, datetime(2001, 8, 1))
_CALENDAR = {"calendar_start": CALENDAR[0], "calendar_end": CALENDAR[1], "grain": "year"}
_LEAST_BUCKETS, _LINES_PER_BUCKET = 4, 2_000_000


def _fresh_name(spark: SparkSession, purpose: str) -> str:
    """A name in the catalog that no other run of the query has."""
    return f"layercake.{purpose}_{shared_dir(spark, purpose).rsplit('-', 1)[1]}"


# ------------------------------------------------------------------------------- loads and the catalog


def csv_load_bad(spark: SparkSession, directory: str) -> DataFrame:
    """Raw trucks as delimited text with rows between them that do not fit: what is left out, and from which folder."""
    raw = raw_tables(prepare(spark), directory)["truck"]
    path = shared_dir(spark, "trucks-csv")
    raw.write.csv(f"{path}/good")
    names = table(spark, directory, "supplier").select(F.concat_ws(",", F.lit("no number"), c("s_suppkey")).alias("value"))
    names.write.text(f"{path}/bad")
    trucks, bad = load_raw(spark, "truck", path, most_bad=10**12)
    kept = trucks.select(F.lit("good").alias("folder"), c("truck_id").cast("string").alias("row"))
    return kept.unionByName(bad.select(F.element_at(F.split("file", "/"), -2).alias("folder"), "row"))


def catalog_view_of_orders(spark: SparkSession, directory: str) -> DataFrame:
    """A view in the catalog on a table of the catalog."""
    name = _fresh_name(prepare(spark), "orders")
    orders = table(spark, directory, "orders").select(*ORDER_COLUMNS)
    write_table(orders, name, bucket_by=["o_custkey"], buckets=4)
    return catalog_view(
        spark, f"{name}_by_customer",
        f"SELECT o_custkey, COUNT(*) AS orders, SUM(o_totalprice) AS total FROM {name} GROUP BY o_custkey",
    )


def documents_from_files(spark: SparkSession, directory: str) -> DataFrame:
    """Documents of the nations, one file each, with the market segments of their customers as tasks; loaded twice."""
    customers = table(spark, directory, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    task = F.struct(c("c_mktsegment").alias("name"), F.lit("run").alias("dbt_command"), (c("n") % 2 == 0).alias("enabled"))
    tasks = customers.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(task)).alias("tasks"))
    config = F.struct(F.lit("db").alias("database"), F.lit("s").alias("schema"), c("n_name").alias("project_name"))
    nations = table(spark, directory, "nation").join(tasks, c("n_nationkey") == c("c_nationkey"))
    path = shared_dir(prepare(spark), "documents")
    text = nations.select(F.to_json(F.struct(config.alias("project_config"), "tasks")).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(f"{path}/feeds")
    first, second = (ops.load_json_docs(spark, f"{path}/feeds", F.lit(datetime(2024, 1, day))) for day in (1, 2))
    docs = ops.replace_docs(first, second)
    named = F.variant_get("config_data", "$.project_config.project_name", "string")
    valid = ops.validate_document(docs).where("is_valid").select("feed_name")
    items = ops.explode_items(docs.withColumn("project", named), "config_data", "$.tasks", ["feed_name", "project", "loaded_at"])
    return items.join(valid, "feed_name").select(
        "project", "index", F.variant_get("value", "$.name", "string").alias("task_name"),
        F.variant_get("value", "$.enabled", "boolean").alias("enabled"), c("loaded_at").cast("timestamp_ntz"),
        (~c("feed_name").contains(".") & c("feed_name").startswith("part-")).alias("named_after_file"),
    )


def ordered_feeds(spark: SparkSession, directory: str) -> DataFrame:
    """The listing of feeds, newest first."""
    return ops.feed_summary(documents(prepare(spark), directory), ordered=True)


def ordered_tasks(spark: SparkSession, directory: str) -> DataFrame:
    """The listing of tasks by feed and place."""
    listed = ops.feed_items(documents(prepare(spark), directory), ordered=True)
    return listed.select("feed_name", "index", "task_name", "enabled")


def menu_health_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """The documents that staged items carry on."""
    items = layers(spark, directory)["stg_pos_menu"]
    return items.select("menu_item_id", F.to_json("health_metrics").alias("health_metrics"))


def loaded_tables(spark: SparkSession, directory: str) -> DataFrame:
    """Raw tables written to the catalog: whether each is there, its rows, and the note at the end of the load."""
    raw, found = raw_tables(prepare(spark), directory), []
    for name in RAW_SCHEMAS:
        schema, _, stored = _fresh_name(spark, name).partition(".")
        was = table_exists(spark, schema, stored)
        rows = write_table(raw[name], f"{schema}.{stored}").agg(F.count("*").alias("n"))
        found.append(rows.select(
            F.lit(name).alias("name"), F.lit(was).alias("was_there"),
            F.lit(table_exists(spark, schema, stored)).alias("is_there"), c("n").alias("n_rows"),
        ))
    note = load_note(spark, "loaded")
    listed = found[0]
    for rows in found[1:]:
        listed = listed.unionByName(rows)
    return listed.crossJoin(F.broadcast(note))


# --------------------------------------------------------------------------------------- marks


def hwm_from_footers(spark: SparkSession, directory: str) -> DataFrame:
    """Orders above the mark of a stored table, which its footers tell."""
    orders = table(prepare(spark), directory, "orders").select(*ORDER_COLUMNS)
    path = shared_dir(spark, "early-orders")
    orders.where(c("o_orderkey") % 3 == 0).where(c("o_orderdate") <= F.lit(datetime(2000, 1, 1))).write.parquet(path)
    return new_rows(orders, spark.read.parquet(path), "o_orderkey", "o_orderkey", stored=True)


def freshness_from_footers(spark: SparkSession, directory: str) -> DataFrame:
    """Newest order against its limits, without reading the orders."""
    path = shared_dir(prepare(spark), "orders")
    table(spark, directory, "orders").write.parquet(path)
    found = freshness(spark.read.parquet(path), "o_orderdate", 48, 72, F.lit(datetime(2001, 8, 2)), stored=True)
    return found.withColumn("loaded_at", c("loaded_at").cast("timestamp_ntz"))


# --------------------------------------------------------------------------------------- builds


def buckets_for(lines: int) -> int:
    """Each bucket is sorted and written by one task, so their number follows the lines."""
    return max(_LEAST_BUCKETS, -(-lines // _LINES_PER_BUCKET))


def middle_id(lines: DataFrame) -> int | None:
    """The median of the line ids, exact; no task holds more than a slice of them. None if there are none."""
    ids = lines.select(F.lit(0).alias("of"), "order_detail_id")
    found = ops.grouped_median(ids, ["of"], "order_detail_id", "half").select(c("half").cast("bigint")).first()
    return None if found is None else found[0]


def built_facts(spark: SparkSession, directory: str) -> DataFrame:
    """Silver tables and the order lines of the star schema, built in two runs by audit marks, stored in buckets."""
    base, raw = shared_dir(prepare(spark), "facts"), dict(raw_tables(spark, directory))
    headers, lines = ops.settle(raw["order_header"], "headers"), ops.settle(raw["order_detail"], "lines")
    half, buckets = middle_id(lines), buckets_for(lines.count())
    steps = [(EARLY, headers, lines.where(c("order_detail_id") <= F.lit(half))), (RUN, headers, lines)]
    for run, raw["order_header"], raw["order_detail"] in steps:
        for tags in ({"silver", "staging", "orders"}, {"gold", "fact"}):
            built = build(spark, raw, run, base, tags, gates=False, buckets=buckets, **_CALENDAR)
    return built["fact_order_detail"]


def gated_build(spark: SparkSession, directory: str) -> DataFrame:
    """A build with gates: the tests that stop it, as counted while the tables were written."""
    base, raw = shared_dir(prepare(spark), "gated"), raw_tables(spark, directory)
    try:
        build(spark, raw, RUN, base, {"silver", "intermediate"}, **_CALENDAR)
    except GateFailed as stop:
        return spark.createDataFrame(stop.failing, RESULT)
    return spark.createDataFrame([], RESULT)


def _refreshed(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The mart over the orders before 2000, then brought up to date with the others."""
    raw = dict(raw_tables(prepare(spark), directory))
    target, headers = shared_dir(spark, name), raw["order_header"]
    cut = F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    early = {**raw, "order_header": headers.where(c("order_ts") < cut)}
    refresh_mart(Layers(spark, early, EARLY, *CALENDAR, write_shared=True), name, target)
    whole = Layers(spark, raw, RUN, *CALENDAR, write_shared=True)
    # Only what the totals take, so that orders whose lines do not matter are not joined with them.
    whole.keep("fact_order", GROWING[name].columns)
    came = whole["fact_order"].where(c("order_timestamp") >= cut)
    return refresh_mart(whole, name, target, first_changed_day(came))


def daily_sales_by_increments(spark: SparkSession, directory: str) -> DataFrame:
    return _refreshed(spark, directory, "agg_daily_sales")


def location_insights_by_increments(spark: SparkSession, directory: str) -> DataFrame:
    return _refreshed(spark, directory, "agg_location_insights")


def menu_performance_by_increments(spark: SparkSession, directory: str) -> DataFrame:
    return _refreshed(spark, directory, "agg_menu_performance")


def members_by_period(spark: SparkSession, directory: str) -> DataFrame:
    """Customers and trucks per day, month and year: days are read once, the rest is merged from their bitmaps."""
    orders = raw_tables(prepare(spark), directory)["order_header"].select(
        "customer_id", "truck_id", F.to_date("order_ts").alias("day")
    )
    found = []
    for member, name in (("customer_id", "customers"), ("truck_id", "trucks")):
        numbered = orders.join(ops.number_members(orders, member), member)
        days = ops.settle(ops.member_bitmaps(numbered, ["day"], "number"), f"days-{name}")
        parts = {
            "day": days,
            "month": ops.merge_bitmaps(days.withColumn("day", F.trunc("day", "month")), ["day"]),
            "year": ops.merge_bitmaps(days.withColumn("day", F.trunc("day", "year")), ["day"]),
        }
        found += [
            ops.count_members(bitmaps, ["day"], "members")
            .select(F.lit(period).alias("period"), F.lit(name).alias("of"), c("day").alias("start"), "members")
            for period, bitmaps in parts.items()
        ]
    counted = found[0]
    for rows in found[1:]:
        counted = counted.unionByName(rows)
    return counted


def catalog_increments(spark: SparkSession, directory: str) -> DataFrame:
    """Orders upserted into a named, bucketed table of the catalog; columns come and go with the batches."""
    name = _fresh_name(prepare(spark), "increments")
    orders = table(spark, directory, "orders")
    part = F.year("o_orderdate").alias("part")
    first = orders.select("o_orderkey", "o_totalprice", "o_orderstatus", part)
    late = orders.where(c("o_orderstatus") == "O").select("o_orderkey", "o_totalprice", "o_orderpriority", part)
    ops.upsert_table(first, name, "o_orderkey", "sync", "part", buckets=catalog.Buckets(("o_orderkey",), 4))
    ops.upsert_table(late, name, "o_orderkey", "sync", "part")
    catalog.forget_versions(spark, name)
    return ops.read_upserted(spark, name).drop("part")
