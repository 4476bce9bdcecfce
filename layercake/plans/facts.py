"""Gold facts: orders and order lines with the keys of their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.operators.joins import lookup_key
from layercake.plans.run import Run

c = F.col


def fact_order(
    orders: DataFrame,
    trucks: DataFrame,
    locations: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    run: Run,
    ids: bool = False,
) -> DataFrame:
    """Orders with five dimension keys, '-1' (or -1) where a dimension has no such member.

    Each dimension needs its natural and surrogate key only. Calendars are broadcast;
    how the others are joined is decided at run time by their bytes. NULL customer ids are spread by order. With ``ids`` the id of
    known customers comes along, for marts: a number travels in a fraction of the bytes of a surrogate key.
    """
    rows = lookup_key(
        orders, customers, c("customer_id"), c("customer_id"), "customer_sk", rules.UNKNOWN_KEY,
        spread_by="order_id", member="_customer" if ids else None,
    )
    rows = lookup_key(rows, trucks, c("truck_id"), c("truck_id"), "truck_sk", rules.UNKNOWN_KEY)
    # The orders hold the location id as a floating point number.
    rows = lookup_key(
        rows, locations, c("location_id").cast("double"), c("location_id").cast("double"),
        "location_sk", rules.UNKNOWN_KEY,
    )
    rows = lookup_key(
        rows, F.broadcast(dates), F.to_date("order_timestamp"), c("date_actual"), "date_sk",
        rules.UNKNOWN_NUMBER, alias="order_date_sk",
    )
    minute = c("hour_24") * 60 + c("minute_number")
    rows = lookup_key(
        rows, F.broadcast(times), fn.minute_of_day(c("order_timestamp"), run.time_match), minute,
        "time_sk", rules.UNKNOWN_NUMBER, alias="order_time_sk",
    )
    facts = rows.select(
        fn.surrogate_key(c("order_id")).alias("order_sk"),
        "order_id",
        "truck_sk",
        "location_sk",
        "customer_sk",
        "order_date_sk",
        "order_time_sk",
        "shift_id",
        "shift_start_time",
        "shift_end_time",
        "order_channel",
        "order_timestamp",
        "served_timestamp",
        "order_currency",
        "meal_period",
        "order_hour",
        "order_day_of_week",
        "order_amount",
        "order_tax_amount",
        "order_discount_amount",
        "order_total",
        "total_cost_of_goods",
        "order_profit",
        "order_profit_margin_pct",
        "processing_time_minutes",
        "line_item_count",
        "total_items_ordered",
        "avg_item_price",
        "order_size_category",
        "service_speed_category",
        "revenue_category",
        "discount_percentage",
        "category_count",
        "categories_ordered",
        "created_ts",
        *([c("_customer").alias("customer_id")] if ids else []),
    )
    return run.audited(facts)


def fact_order_detail(
    details: DataFrame, orders: DataFrame, items: DataFrame, run: Run, ids: bool = False
) -> DataFrame:
    """Valid lines with the keys of their order and item.

    The order's key is a function of its id, so of the order fact only the ids take part in the
    join; it decides between the key and '-1'. The orders come last: with ``ids`` the order's id comes along, for marts, and
    lines that have just met the orders by it meet them again without another shuffle; so does the id of known items.
    """
    carry = (
        "cost_of_goods_usd", "item_category", "item_subcategory", "truck_brand_name",
        "is_vegetarian", "is_vegan", "is_gluten_free",
    )
    valid = details.where("is_valid_line_item")
    side = items.select(c("menu_item_id").alias("_item"), "menu_item_sk", *carry)
    rows = valid.join(side, c("menu_item_id") == c("_item"), "left")
    known = orders.select(c("order_id").alias("_order"))
    rows = rows.join(known, c("order_id") == c("_order"), "left")
    cost = c("quantity") * F.coalesce(c("cost_of_goods_usd"), F.lit(0).cast("decimal(18,4)"))
    net = c("net_line_total")
    facts = rows.select(
        fn.surrogate_key(c("order_detail_id")).alias("order_detail_sk"),
        "order_detail_id",
        F.when(c("_order").isNotNull(), fn.surrogate_key(c("order_id")))
        .otherwise(rules.UNKNOWN_KEY)
        .alias("order_sk"),
        F.coalesce("menu_item_sk", F.lit(rules.UNKNOWN_KEY)).alias("menu_item_sk"),
        "discount_id",
        "line_number",
        "quantity",
        "unit_price",
        "line_total",
        "line_discount_amount",
        "net_line_total",
        "line_discount_percentage",
        cost.alias("line_cost_of_goods"),
        (net - cost).alias("line_profit"),
        fn.safe_pct(net - cost, net).alias("line_profit_margin_pct"),
        "item_category",
        "item_subcategory",
        "truck_brand_name",
        "is_vegetarian",
        "is_vegan",
        "is_gluten_free",
        "is_valid_line_item",
        "price_quantity_consistent",
        "created_ts",
        *(["order_id", c("_item").alias("menu_item_id")] if ids else []),
    )
    return run.audited(facts)
