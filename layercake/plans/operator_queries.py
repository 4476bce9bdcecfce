"""Single operators at work on whole tables of the orders-and-parts data set.

Each function takes (spark, directory) and shows one operator of the library; the models show them
combined.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import operators as ops
from layercake import rules
from layercake.operators.counts import keys_repeat
from layercake.operators.windows import lag_by
from layercake.plans import calendar
from layercake.plans.build import MODELS, Layers, build
from layercake.plans.dimensions import key_table
from layercake.plans.intermediate import average_gap, lifetime_value, order_history
from layercake.plans.run import Run
from layercake.plans.staging import stg_pos_order_headers
from layercake.quality import Rule, check
from layercake.quality.catalogue import RULES
from layercake.quality.suite import check_models
from layercake.session import prepare, shared_dir
from layercake.sources import as_raw, freshness, raw_tables, read_raw
from layercake.sources.adapter import base_table
from layercake.sources.readers import declared_freshness, source
from layercake.sources.sinks import as_view
from layercake.streaming import file_stream, upsert_stream

AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = datetime(2024, 1, 31)
RUN = Run(AS_OF, datetime(2001, 8, 2))
CALENDAR = ("1995-01-01", "2002-01-01")
c = F.col


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return base_table(prepare(spark), directory, name)


def layers(spark: SparkSession, directory: str) -> Layers:
    return Layers(prepare(spark), raw_tables(spark, directory), RUN, *CALENDAR, write_shared=True)


def mart_layers(spark: SparkSession, directory: str) -> Layers:
    """With a look at the order ids first, as a build has it before the marts."""
    raw = raw_tables(prepare(spark), directory)
    run = replace(RUN, unique_orders=not keys_repeat(raw["order_header"], "order_id"))
    return Layers(spark, raw, run, *CALENDAR, write_shared=True)


# ------------------------------------------------------------------------------------- calendars


def dim_date(spark: SparkSession, directory: str) -> DataFrame:
    """The calendar with the orders and revenue of each day."""
    days = table(spark, directory, "orders").groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(
        F.count("*").alias("orders"), F.sum(c("o_totalprice").cast("decimal(18,2)")).alias("revenue")
    )
    calendar_days = calendar.dim_date(spark, *CALENDAR)
    return calendar_days.join(days, "date_actual", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def dim_time(spark: SparkSession, directory: str) -> DataFrame:
    """The minutes of the day with the events and users of each."""
    minutes = table(spark, directory, "events").groupBy(fn.minute_of_day(c("ts"), "minute").alias("_m")).agg(
        F.count("*").alias("events"), F.countDistinct("user_id").alias("users")
    )
    times = calendar.dim_time(spark)
    joined = times.join(minutes, c("hour_24") * 60 + c("minute_number") == c("_m"), "left").drop("_m")
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("events", "users")})


# --------------------------------------------------------------------------- labels, text and keys


def normalize_labels(spark: SparkSession, directory: str) -> DataFrame:
    raw = raw_tables(prepare(spark), directory)["order_header"]
    channel = fn.normalize(fn.code(c("order_channel")), rules.CHANNELS, "Other")
    return raw.groupBy(channel.alias("channel")).agg(
        F.count("*").alias("orders"), F.sum("order_total").alias("revenue")
    )


def band_labels(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders")
    age = F.datediff(F.lit(AS_OF), F.to_date("o_orderdate"))
    return orders.select(
        "o_orderkey",
        fn.band(age, "<=", rules.TENURE_MAX, "Veteran").alias("age_band"),
        fn.band(c("o_totalprice") / 1000, ">=", rules.VALUE_TIER_MIN, "Minimal Value").alias("value_band"),
        fn.between_band(F.month("o_orderdate"), [((1, 6), "First half")], "Second half").alias("half"),
    )


def keyword_classify(spark: SparkSession, directory: str) -> DataFrame:
    words = [(["RING", "GEAR"], "Round"), (["WIDGET", "GADGET"], "Device"), (["BOLT", "NUT"], "Fastener")]
    name = F.upper("p_name")
    return table(spark, directory, "part").select(
        "p_partkey",
        fn.keyword_class(name, words, "Other").alias("kind"),
        fn.contains_any(name, ["RED", "BLUE"]).alias("is_coloured"),
    )


def clean_text(spark: SparkSession, directory: str) -> DataFrame:
    people = raw_tables(prepare(spark), directory)["customer_loyalty"]
    return people.select(
        "customer_id",
        fn.full_name(c("first_name"), c("last_name")).alias("full_name"),
        fn.clean_email(c("e_mail")).alias("email"),
        fn.digits(c("phone_number")).alias("phone"),
        fn.code(c("postal_code")).alias("postal_code"),
        fn.clean_name(c("country")).alias("country"),
        fn.clamp(c("children_count").try_cast("int"), 1, 2).alias("children"),
    )


def surrogate_keys(spark: SparkSession, directory: str) -> DataFrame:
    raw = raw_tables(prepare(spark), directory)["order_header"]
    return raw.select(
        "order_id",
        fn.surrogate_key(c("order_id")).alias("order_sk"),
        fn.surrogate_key(c("truck_id"), c("customer_id")).alias("pair_sk"),
    )


# ----------------------------------------------------------------------------------- rows and joins

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def keep_latest(spark: SparkSession, directory: str) -> DataFrame:
    """The line shipped last for every (order, line number)."""
    lines = table(spark, directory, "lineitem").select(*LINE_COLUMNS)
    return ops.keep_latest(lines, ["l_orderkey", "l_linenumber"], [c("l_shipdate").desc()])


def left_join_preserved_cond(spark: SparkSession, directory: str) -> DataFrame:
    """Customers, with a supplier of the same number only where the balance is positive."""
    customers = table(spark, directory, "customer").select("c_custkey", "c_acctbal", c("c_custkey").alias("id"))
    suppliers = table(spark, directory, "supplier").select(c("s_suppkey").alias("id"), "s_name")
    return ops.left_join_where_left(customers, suppliers, "id", c("c_acctbal") > 0).drop("id")


def unknown_member(spark: SparkSession, directory: str) -> DataFrame:
    """Orders by customer and location key, '-1' for a missing member."""
    built = layers(spark, directory)
    rows = ops.lookup_key(
        raw_tables(spark, directory)["order_header"], built["customer_keys"], c("customer_id"),
        c("customer_id"), "customer_sk", rules.UNKNOWN_KEY, spread_by="order_id",
    )
    rows = ops.lookup_key(
        rows, built["location_keys"], c("location_id").cast("double"), c("location_id").cast("double"),
        "location_sk", rules.UNKNOWN_KEY,
    )
    return rows.groupBy("customer_sk", "location_sk").agg(
        F.count("*").alias("orders"), F.sum("order_total").alias("revenue")
    )


# -------------------------------------------------------------------------------------- aggregates


def cond_distinct(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct orders per supplier under several conditions, in two plain aggregates."""
    lines = table(spark, directory, "lineitem")
    return ops.conditional_counts(
        lines,
        ["l_suppkey"],
        "l_orderkey",
        {
            "orders": None,
            "returned_orders": c("l_returnflag") == "R",
            "discounted_orders": c("l_discount") > 0.05,
            "large_orders": c("l_quantity") >= 40,
        },
        {"quantity": c("l_quantity").cast("long")},
    )


def mode_det(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem").withColumn("quantity", c("l_quantity").cast("int"))
    return ops.grouped_mode(lines, ["l_suppkey"], "quantity", "usual_quantity")


def median_price(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem")
    return ops.grouped_median(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price")


def distinct_list(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "lineitem").groupBy("l_orderkey").agg(
        fn.distinct_list(c("l_returnflag")).alias("flags"),
        F.count("*").alias("lines"),
        fn.safe_pct(F.count(F.when(c("l_discount") > 0, 1)), F.count("*")).alias("discounted_pct"),
    )


def customer_preferences(spark: SparkSession, directory: str) -> DataFrame:
    """Favourite categories, dietary shares and price levels per customer."""
    from layercake.plans.analytics import customer_tastes

    built = layers(spark, directory)
    return customer_tastes(built["fact_order"], built["order_lines"], built["dim_menu_item"])


# ------------------------------------------------------------------------------- ranks and windows


def rank_by_day(spark: SparkSession, directory: str) -> DataFrame:
    """Orders ranked by price within their day; days of any size."""
    orders = table(spark, directory, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day")
    )
    return ops.rank_by_pieces(orders, ["order_day"], "o_totalprice", "day_rank", ["o_orderkey"])


def nation_days(spark: SparkSession, directory: str) -> DataFrame:
    """Revenue per nation and day: series no longer than the calendar."""
    customers = table(spark, directory, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, directory, "orders").select(
        c("o_custkey").alias("c_custkey"),
        F.to_date("o_orderdate").alias("day"),
        c("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    return (
        orders.join(customers, "c_custkey")
        .groupBy(c("c_nationkey").alias("nation"), "day")
        .agg(F.sum("price").alias("revenue"), F.count("*").alias("orders"))
    )


def rolling_avg_7(spark: SparkSession, directory: str) -> DataFrame:
    days = nation_days(spark, directory)
    return days.withColumns(
        {
            "revenue_avg": ops.rolling_avg(["nation"], "day", "revenue", 7),
            "orders_avg": ops.rolling_avg(["nation"], "day", "orders", 7),
        }
    )


def lag7_growth(spark: SparkSession, directory: str) -> DataFrame:
    days = nation_days(spark, directory)
    before = lag_by(["nation"], "day", "revenue", 7)
    return days.withColumn("revenue_before", before).withColumn(
        "growth_pct", ops.lag_growth(c("revenue"), c("revenue_before"))
    )


def first_value_month(spark: SparkSession, directory: str) -> DataFrame:
    days = nation_days(spark, directory).withColumn("weekday", F.date_format("day", "EEEE"))
    best = [c("revenue").desc(), c("day").asc()]
    return days.select(
        "nation", "day", ops.first_by(["nation", fn.month_of(c("day"))], best, "weekday").alias("best_weekday")
    )


def weekend_weekday_avg(spark: SparkSession, directory: str) -> DataFrame:
    weekend = fn.dow0(c("day")).isin(0, 6)
    days = nation_days(spark, directory).withColumn("month", fn.month_of(c("day")))
    return (
        days.withColumn("weekend", ops.partition_avg(["nation", "month"], "revenue", weekend))
        .withColumn("weekday", ops.partition_avg(["nation", "month"], "revenue", ~weekend))
        .select("nation", "day", "weekend", "weekday", fn.safe_ratio(c("weekend"), c("weekday")).alias("ratio"))
    )


def season_avg(spark: SparkSession, directory: str) -> DataFrame:
    season = fn.normalize(F.month("day"), rules.SEASONS, "Fall")
    days = nation_days(spark, directory).withColumn("season", season)
    return days.select(
        "nation", "day", "season", ops.partition_avg(["nation", "season"], "revenue").alias("season_avg")
    )


def peak_period(spark: SparkSession, directory: str) -> DataFrame:
    """The part of the day in which a user is most active; the earlier among equals."""
    part = fn.between_band(F.hour("ts"), rules.DAY_PARTS, "Night")
    names = [label for _, label in rules.DAY_PARTS]
    counted = table(spark, directory, "events").groupBy("user_id").agg(
        *[F.count(F.when(part == name, 1)).alias(f"_{n}") for n, name in enumerate(names)],
        F.count("*").alias("events"),
    )
    peak = fn.peak_of([(name, c(f"_{n}")) for n, name in enumerate(names)])
    return counted.select("user_id", "events", peak.alias("peak"))


# ------------------------------------------------------------------------------ customers over time


def recency_90d(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders")
    price = c("o_totalprice").cast("decimal(18,2)")
    recent = F.to_date("o_orderdate") >= RUN.days_ago(rules.RECENT_DAYS)
    return orders.groupBy("o_custkey").agg(
        F.count(F.when(recent, 1)).alias("recent_orders"),
        F.sum(F.when(recent, price).otherwise(0)).alias("recent_spent"),
        F.datediff(F.lit(AS_OF), F.max(F.to_date("o_orderdate"))).alias("days_since_last"),
    )


def rfm_segment(spark: SparkSession, directory: str) -> DataFrame:
    """Segments and projected value of customers, from their order history."""
    built = layers(spark, directory)
    history = order_history(built["stg_pos_order_headers"], RUN)
    made, spent = c("total_orders"), c("total_spent")
    return history.select(
        "customer_id",
        "total_orders",
        "total_spent",
        average_gap(c("first_order_date"), c("last_order_date"), made).alias("gap"),
        lifetime_value(spent, c("avg_order_value"), made, c("avg_days_between_orders"), F.lit(0.0)).alias("value"),
        fn.classify(
            rules.SEGMENTS, "Occasional", recency=c("days_since_last_order"), orders=made, spent=spent,
            signup=F.lit(None).cast("int"),
        ).alias("segment"),
    )


# -------------------------------------------------------------------------------- JSON documents


def json_extract(spark: SparkSession, directory: str) -> DataFrame:
    """A field of the events' properties, summed per event type."""
    events = table(spark, directory, "events").withColumn("doc", F.parse_json("props"))
    k = fn.variant_field(c("doc"), "$.k", "decimal(38,0)")
    return events.groupBy("event_type").agg(
        F.count(k).alias("with_k"),
        F.sum(k).alias("sum_k"),
        F.count(F.when(fn.variant_field(c("doc"), "$.absent", "string").isNull(), 1)).alias("without_absent"),
    )


# One document per part: settings and three tasks, with gaps in every kind of field.
DOCUMENT = (
    "CONCAT('{\"project_config\":{\"database\":\"db\",\"schema\":\"s\"', "
    "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ',\"project_name\":\"p\"' END, '},\"tasks\":[', "
    "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CONCAT("
    "'{\"name\":\"load\",\"dbt_command\":\"run\",\"enabled\":', "
    "CASE WHEN p_partkey % 3 = 0 THEN 'false' ELSE 'true' END, ',\"depends_on\":[]},', "
    "'{\"name\":\"clean\",', CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '\"dbt_command\":\"run\",' END, "
    "'\"depends_on\":[\"load\"]},', "
    "'{\"name\":\"test\",\"dbt_command\":\"test\",\"schedule\":\"daily\",\"enabled\":', "
    "CASE WHEN p_partkey % 4 = 0 THEN 'false' ELSE 'true' END, "
    "',\"depends_on\":[\"load\",\"clean\",\"gone\"]}') END, ']}')"
)


def documents(spark: SparkSession, directory: str) -> DataFrame:
    parts = table(spark, directory, "part")
    return parts.select(
        F.concat(F.lit("feed_"), c("p_partkey").cast("string")).alias("feed_name"),
        F.parse_json(F.expr(DOCUMENT)).alias("config_data"),
        F.timestamp_add("SECOND", c("p_partkey").cast("int"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
        .alias("loaded_at"),
    )


def json_explode(spark: SparkSession, directory: str) -> DataFrame:
    return ops.feed_items(documents(spark, directory)).withColumn(
        "depends_on", F.concat_ws(",", "depends_on")
    )


def feed_summary(spark: SparkSession, directory: str) -> DataFrame:
    return ops.feed_summary(documents(spark, directory))


def document_validate(spark: SparkSession, directory: str) -> DataFrame:
    return ops.validate_document(documents(spark, directory))


def document_newest(spark: SparkSession, directory: str) -> DataFrame:
    """Every feed has an older document without tasks; the newest one is validated."""
    docs = documents(spark, directory)
    older = docs.withColumns({
        "config_data": F.parse_json(F.lit('{"project_config": {}, "tasks": []}')),
        "loaded_at": F.timestamp_add("DAY", F.lit(-1), c("loaded_at")),
    })
    return ops.validate_document(older.unionByName(docs))


def document_replace(spark: SparkSession, directory: str) -> DataFrame:
    """Documents of even parts arrive again, later; each feed keeps one."""
    docs = documents(spark, directory)
    even = F.substring_index("feed_name", "_", -1).cast("long") % 2 == 0
    again = docs.where(even).withColumn("loaded_at", F.timestamp_add("DAY", F.lit(1), c("loaded_at")))
    merged = ops.replace_docs(docs, again)
    return merged.select("feed_name", F.to_json("config_data").isNotNull().alias("has_data"), "loaded_at")


def dependency_filter(spark: SparkSession, directory: str) -> DataFrame:
    return ops.dependency_filter(documents(spark, directory)).withColumn(
        "depends_on", F.concat_ws(",", "depends_on")
    )


# ---------------------------------------------------------------------------- incremental loading

MARK = datetime(2001, 1, 1)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def hwm_filter(spark: SparkSession, directory: str) -> DataFrame:
    """Orders above the newest one of those already loaded, and lines above the largest id."""
    orders = table(spark, directory, "orders").select(*ORDER_COLUMNS)
    loaded = orders.where(c("o_orderdate") <= F.lit(MARK).cast("timestamp_ntz"))
    return ops.new_rows(orders, loaded, "o_orderdate", "o_orderdate")


def hwm_by_id(spark: SparkSession, directory: str) -> DataFrame:
    details = raw_tables(prepare(spark), directory)["order_detail"].select("order_detail_id", "order_id", "price")
    loaded = details.where(c("order_detail_id") % 3 == 0).where(c("price") < 5)
    return ops.new_rows(details, loaded, "order_detail_id", "order_detail_id")


def _batch(orders: DataFrame) -> DataFrame:
    """Corrections of finished orders, and new orders under new keys."""
    fixed = orders.where(c("o_orderstatus") == "F").withColumn("o_totalprice", c("o_totalprice") + 1)
    new = orders.where(c("o_orderstatus") == "O").withColumn("o_orderkey", -c("o_orderkey") - 1)
    return fixed.unionByName(new)


def incremental_upsert(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders").select(*ORDER_COLUMNS)
    return ops.upsert(orders, _batch(orders), "o_orderkey")


def incremental_table(spark: SparkSession, directory: str) -> DataFrame:
    """The same upsert into a written table, partition by partition; applied twice, as a retry would."""
    year = F.year("o_orderdate").alias("part")
    orders = table(spark, directory, "orders").select(*ORDER_COLUMNS, year)
    path = shared_dir(spark, "orders")
    for batch in (orders, _batch(orders), _batch(orders)):
        ops.upsert_table(batch, path, "o_orderkey", partition_by="part")
    return ops.read_upserted(spark, path).select(*ORDER_COLUMNS)


def stream_upsert(spark: SparkSession, directory: str) -> DataFrame:
    """Order headers cleaned and upserted as a stream of files; the same rows as the batch model."""
    schema = table(spark, directory, "orders").schema
    path = shared_dir(spark, "stream")
    # A pattern, as the table may be one file or a folder of files.
    stream = as_raw(file_stream(spark, f"{directory}/orders*.parquet", schema), "order_header")

    def clean(batch: DataFrame) -> DataFrame:
        return stg_pos_order_headers(batch, RUN).withColumn("part", F.year("order_timestamp"))

    upsert_stream(
        stream, clean, f"{path}/table", "order_id", f"{path}/checkpoint", partition_by="part"
    ).awaitTermination()
    return ops.read_upserted(spark, f"{path}/table")


def schema_sync(spark: SparkSession, directory: str) -> DataFrame:
    """A batch without the status but with a priority: one column goes, one comes."""
    orders = table(spark, directory, "orders")
    target = orders.select(*ORDER_COLUMNS)
    batch = orders.where(c("o_orderstatus") == "P").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return ops.upsert(target, batch, "o_orderkey", on_schema_change="sync")


def csv_load(spark: SparkSession, directory: str) -> DataFrame:
    """Raw menu written as delimited text and loaded again in the declared schema."""
    menu = raw_tables(prepare(spark), directory)["menu"]
    path = shared_dir(spark, "menu-csv")
    menu.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    loaded = read_raw(spark, "menu", path)
    calories = fn.variant_field(c("menu_item_health_metrics_obj"), "$.calories", "bigint")
    return loaded.withColumn("calories", calories).drop("menu_item_health_metrics_obj")


# ---------------------------------------------------------------------------------- data quality


def _checked(spark: SparkSession, directory: str, name: str, *tests: Rule) -> DataFrame:
    return check(
        table(spark, directory, name), name, list(tests), lambda parent: table(spark, directory, parent)
    )


def dq_unique(spark: SparkSession, directory: str) -> DataFrame:
    return _checked(
        spark, directory, "lineitem", Rule("l_orderkey", "unique"), Rule("l_partkey", "unique", where="l_quantity > 49"),
    )


def dq_not_null(spark: SparkSession, directory: str) -> DataFrame:
    headers = raw_tables(prepare(spark), directory)["order_header"]
    columns = ["order_id", "customer_id", "order_currency", "served_ts"]
    return check(headers, "order_header", [Rule(name, "not_null") for name in columns])


def dq_accepted(spark: SparkSession, directory: str) -> DataFrame:
    return _checked(
        spark, directory, "orders",
        Rule("o_orderstatus", "accepted_values", values=("F", "O")),
        Rule("o_orderpriority", "accepted_values", values=("1-URGENT", "2-HIGH"), severity="warn"),
    )


def dq_range(spark: SparkSession, directory: str) -> DataFrame:
    return _checked(
        spark, directory, "lineitem",
        Rule("l_quantity", "accepted_range", low=5, high=45),
        Rule("l_extendedprice", "accepted_range", high=50000, where="l_returnflag = 'R'"),
    )


def dq_relationship(spark: SparkSession, directory: str) -> DataFrame:
    orders = raw_tables(prepare(spark), directory)["order_header"]
    rule = Rule("customer_id", "relationships", parent="customer_loyalty", field="customer_id")
    some = raw_tables(spark, directory)["customer_loyalty"].where(c("customer_id") % 3 != 0)
    return check(orders, "order_header", [rule], lambda _: some)


def dq_expression(spark: SparkSession, directory: str) -> DataFrame:
    return _checked(
        spark, directory, "lineitem",
        Rule("tax_below_discount", "expression_is_true", expression="l_tax <= l_discount", severity="warn"),
        Rule("price_per_unit", "expression_is_true", expression="l_extendedprice / l_quantity < 5000",
             where="l_quantity > 1"),
    )


_SILVER = ["stg_pos_order_headers", "stg_pos_order_details", "int_orders_enriched",
           "int_menu_profitability", "int_customers_segmented"]
_MARTS = ["agg_daily_sales", "agg_location_insights", "agg_menu_performance", "agg_customer_360"]
_CORE = [name for name in RULES if name not in (*_SILVER, *_MARTS)]


# What the marts read of the orders and of the facts; lines and orders meet on the ids.
_MART_ORDERS = (
    "order_id", "order_channel", "meal_period", "order_hour", "order_total", "total_cost_of_goods", "order_profit",
    "processing_time_minutes", "line_item_count", "total_items_ordered", "discount_percentage",
)
_MART_COLUMNS = {
    "stg_pos_order_details": (
        "order_id", "menu_item_id", "quantity", "unit_price", "line_total", "line_discount_amount", "net_line_total",
        "is_valid_line_item",
    ),
    "int_orders_enriched": (*_MART_ORDERS, "truck_id", "location_id", "customer_id", "order_timestamp"),
    "fact_order": (*_MART_ORDERS, "truck_sk", "location_sk", "customer_sk", "order_date_sk"),
}
_MART_LINES = (
    "order_id", "menu_item_id", "quantity", "unit_price", "line_total", "line_discount_amount", "line_cost_of_goods",
    "line_profit",
)


def _suite(spark: SparkSession, directory: str, names: list[str]) -> DataFrame:
    """The declared tests of some models. What they test and refer to is computed once, in build order."""
    marts = set(names) <= set(_MARTS)
    built = mart_layers(spark, directory) if marts else layers(spark, directory)
    parents = {rule.parent for name in names for rule in RULES[name] if rule.parent}
    shared = {*_MART_COLUMNS, "fact_order_detail", "dim_customer", "dim_menu_item"} if marts else set()
    for name in MODELS:
        if marts and name in _MART_COLUMNS:
            built.keep(name, _MART_COLUMNS[name])
        elif marts and name == "fact_order_detail":
            has_order = (c("order_sk") != rules.UNKNOWN_KEY).alias("_has_order")
            lines = ops.settle(built["order_lines"].select(*_MART_LINES, has_order), name)
            keys = {"order_sk": F.when(c("_has_order"), c("order_id")), "menu_item_sk": c("menu_item_id")}
            built[name] = lines.select(*_MART_LINES, *[fn.member_key(key).alias(sk) for sk, key in keys.items()])
        elif name in {*names, *parents, *shared}:
            built[name] = ops.settle(built[name], name)
    return check_models(built, names)


def dq_suite(spark: SparkSession, directory: str) -> DataFrame:
    """All declared tests of the silver tables."""
    return _suite(spark, directory, _SILVER)


def dq_core(spark: SparkSession, directory: str) -> DataFrame:
    """All declared tests of the star schema and the other silver models."""
    return _suite(spark, directory, _CORE)


def dq_marts(spark: SparkSession, directory: str) -> DataFrame:
    """All declared tests of the marts."""
    return _suite(spark, directory, _MARTS)


def _with_repeats(spark: SparkSession, directory: str) -> Layers:
    """The models over order headers of which a tenth comes twice, as a first load may bring them."""
    raw = dict(raw_tables(prepare(spark), directory))
    headers = raw["order_header"]
    raw["order_header"] = headers.unionByName(headers.where(c("order_id") % 10 == 0))
    return Layers(spark, raw, RUN, *CALENDAR, write_shared=True)


def agg_daily_sales_repeats(spark: SparkSession, directory: str) -> DataFrame:
    return _with_repeats(spark, directory)["agg_daily_sales"]


def agg_location_insights_repeats(spark: SparkSession, directory: str) -> DataFrame:
    return _with_repeats(spark, directory)["agg_location_insights"]


def agg_menu_performance_repeats(spark: SparkSession, directory: str) -> DataFrame:
    return _with_repeats(spark, directory)["agg_menu_performance"]


def agg_customer_360_repeats(spark: SparkSession, directory: str) -> DataFrame:
    return _with_repeats(spark, directory)["agg_customer_360"]


def declared_freshness_of_sources(spark: SparkSession, directory: str) -> DataFrame:
    """The raw tables against the limits that are declared for them."""
    found = declared_freshness(raw_tables(prepare(spark), directory), RUN.now)
    return found.withColumn("loaded_at", c("loaded_at").cast("timestamp_ntz"))


def audit_columns(spark: SparkSession, directory: str) -> DataFrame:
    """When facts were made and changed: the stamp of the run."""
    return layers(spark, directory)["fact_order"].select("order_id", "created_ts", "updated_ts")


def views_and_sources(spark: SparkSession, directory: str) -> DataFrame:
    """Orders of a declared source, found by its name, through a view."""
    base = shared_dir(spark, "sources")
    raw_tables(prepare(spark), directory)["order_header"].write.parquet(f"{base}/raw_pos/order_header")
    as_view(source(spark, "raw_pos", "order_header", base), "declared_orders")
    return spark.sql(
        "SELECT truck_id, COUNT(*) AS orders, SUM(order_total) AS total FROM declared_orders GROUP BY truck_id"
    )


def built_headers(spark: SparkSession, directory: str) -> DataFrame:
    """Staged order headers built as a table in two increments, and read back."""
    base, raw = shared_dir(spark, "built"), dict(raw_tables(prepare(spark), directory))
    whole, built = raw["order_header"], {}
    for headers in (whole.where(c("order_ts") < F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz")), whole):
        raw["order_header"] = headers
        built = build(spark, raw, RUN, base, {"silver", "staging", "orders"}, gates=False, grain="year",
                      calendar_start=CALENDAR[0], calendar_end=CALENDAR[1])
    return built["stg_pos_order_headers"]


def source_freshness(spark: SparkSession, directory: str) -> DataFrame:
    """Newest event and newest order against their limits."""
    events = freshness(table(spark, directory, "events"), "ts", 6, 12, F.lit(EVENTS_AS_OF))
    orders = freshness(table(spark, directory, "orders"), "o_orderdate", 48, 72, F.lit(datetime(2001, 8, 2)))
    named = [df.withColumn("source", F.lit(n)) for n, df in (("events", events), ("orders", orders))]
    return named[0].unionByName(named[1]).withColumn("loaded_at", c("loaded_at").cast("timestamp_ntz"))


def key_members(spark: SparkSession, directory: str) -> DataFrame:
    """The members of a dimension: distinct natural keys and their surrogate keys."""
    headers = layers(spark, directory)["stg_pos_order_headers"]
    return key_table(headers, "customer_id", "customer_sk")
