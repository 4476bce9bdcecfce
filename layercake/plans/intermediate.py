"""Silver, second step: orders with their lines, items with their sales, customers with history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.operators.counts import key_flags
from layercake.plans.run import Run

c = F.col


def lifetime_value(spent: Column, average: Column, orders: Column, gap: Column, otherwise: Column) -> Column:
    """Two years of average orders at the customer's pace; one and a half times the spending where
    no pace is known (a single order, or all on one day)."""
    projected = average * (F.lit(float(rules.DAYS_PER_YEAR)) / F.nullif(gap, F.lit(0.0)))
    return (
        F.when(gap > 0, projected * rules.PROJECTION_YEARS)
        .when(orders > 0, spent.cast("double") * rules.SINGLE_ORDER_FACTOR)
        .otherwise(otherwise)
    )


def average_gap(first: Column, last: Column, orders: Column) -> Column:
    """Mean days between orders, NULL for fewer than two."""
    return F.when(orders > 1, F.datediff(last, first) / F.nullif(orders - 1, F.lit(0)))


def int_orders_enriched(headers: DataFrame, details: DataFrame, menu: DataFrame, run: Run) -> DataFrame:
    """Orders with totals of their valid lines.

    Lines are brought to order grain before they meet the headers, so the only wide shuffles are
    one by order_id on either side, none if both tables are bucketed by it.
    """
    items = menu.select(c("menu_item_id").alias("_item"), "item_category", c("cost_of_goods_usd").alias("_cost"))
    lines = details.where("is_valid_line_item").join(items, c("menu_item_id") == c("_item"), "left")
    cost = F.sum(c("quantity") * c("_cost"))
    # One set serves both the list and its length; it holds the category labels of one order.
    per_order = lines.groupBy("order_id").agg(
        F.count("*").alias("line_item_count"),
        F.sum("quantity").alias("total_items_ordered"),
        F.sum("net_line_total").alias("calculated_order_total"),
        fn.mean(c("unit_price")).alias("avg_item_price"),
        F.sum("line_discount_amount").alias("total_line_discounts"),
        F.size(F.collect_set("item_category")).cast("long").alias("category_count"),
        fn.distinct_list(c("item_category")).alias("categories_ordered"),
        cost.alias("total_cost_of_goods"),
        (F.sum("net_line_total") - cost).alias("order_profit"),
    )
    joined = headers.join(per_order, "order_id", "left")
    return joined.select(
        *[headers[name] for name in headers.columns],
        *[name for name in per_order.columns if name != "order_id"],
        fn.safe_pct(c("order_profit"), c("order_total")).alias("order_profit_margin_pct"),
        fn.classify(rules.ORDER_SIZES, "Extra Large", items=c("total_items_ordered"))
        .alias("order_size_category"),
        fn.band(c("processing_time_minutes"), "<=", rules.SERVICE_SPEED_MAX, "Very Slow")
        .alias("service_speed_category"),
        fn.band(c("order_total"), "<", rules.REVENUE_BELOW, "Premium Value").alias("revenue_category"),
    )


# What int_menu_profitability adds to a staged item: it follows from the item and the sales of its id.
SALES = (
    "orders_containing_item", "total_quantity_sold", "total_revenue", "avg_selling_price", "total_discounts_given",
    "quantity_sold_30_days", "revenue_30_days", "total_profit", "actual_profit_margin_pct", "sales_performance_tier",
    "profitability_tier", "trend_status", "mobile_sales", "walkin_sales", "breakfast_sales", "lunch_sales",
    "dinner_sales", "peak_meal_period",
)


def int_menu_profitability(menu: DataFrame, details: DataFrame, headers: DataFrame, run: Run) -> DataFrame:
    """Items with a valid price and what they sold.

    Lines and headers meet on order_id, which is also the one distinct count, so that count needs
    no shuffle of its own: one row of each order and item is marked, which is a sort that can spill, and the marks are
    summed. The sums per item are combined in the map tasks.
    """
    orders = headers.select("order_id", "order_timestamp", "order_channel", "meal_period")
    lines = details.where("is_valid_line_item").select(
        "order_id", "menu_item_id", "quantity", "unit_price", "net_line_total", "line_discount_amount"
    )
    recent = c("order_timestamp") >= run.now - F.make_dt_interval(F.lit(rules.MENU_RECENT_DAYS))
    quantity, net = c("quantity"), c("net_line_total")

    def sold_where(condition: Column, value: Column = quantity) -> Column:
        return F.sum(F.when(condition, value).otherwise(0))

    sales = (
        key_flags(lines.join(orders, "order_id"), ["menu_item_id"], "order_id", {"_first": None})
        .groupBy("menu_item_id")
        .agg(
            F.sum("_first").alias("orders_containing_item"),
            F.sum(quantity).alias("total_quantity_sold"),
            F.sum(net).alias("total_revenue"),
            fn.mean(c("unit_price")).alias("avg_selling_price"),
            F.sum("line_discount_amount").alias("total_discounts_given"),
            sold_where(recent).alias("quantity_sold_30_days"),
            sold_where(recent, net).alias("revenue_30_days"),
            sold_where(c("order_channel") == "Mobile App").alias("mobile_sales"),
            sold_where(c("order_channel") == "Walk-up").alias("walkin_sales"),
            sold_where(c("meal_period") == "Breakfast").alias("breakfast_sales"),
            sold_where(c("meal_period") == "Lunch").alias("lunch_sales"),
            sold_where(c("meal_period") == "Dinner").alias("dinner_sales"),
        )
    )
    base = menu.where("has_valid_pricing")
    joined = base.join(sales, "menu_item_id", "left")
    sold, revenue = c("total_quantity_sold"), c("total_revenue")
    profit = revenue - sold * c("cost_of_goods_usd")

    def or_zero(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)).alias(name)

    meals = ["breakfast_sales", "lunch_sales", "dinner_sales"]
    trend = fn.first_match(
        [
            (c("quantity_sold_30_days") > sold * F.lit(share).cast("decimal(2,1)"), label)
            for label, share in rules.TREND
        ],
        "Inactive",
    )
    return joined.select(
        *[base[name] for name in base.columns],
        or_zero("orders_containing_item"),
        or_zero("total_quantity_sold"),
        or_zero("total_revenue"),
        F.coalesce(c("avg_selling_price"), c("sale_price_usd").cast("double")).alias("avg_selling_price"),
        or_zero("total_discounts_given"),
        or_zero("quantity_sold_30_days"),
        or_zero("revenue_30_days"),
        profit.alias("total_profit"),
        fn.safe_pct(profit, revenue, c("profit_margin_pct")).alias("actual_profit_margin_pct"),
        fn.band(sold, ">=", rules.SALES_TIER_MIN, "New/Inactive").alias("sales_performance_tier"),
        fn.band(c("profit_margin_pct"), ">=", rules.MARGIN_TIER_MIN, "Unprofitable")
        .alias("profitability_tier"),
        trend.alias("trend_status"),
        or_zero("mobile_sales"),
        or_zero("walkin_sales"),
        *[or_zero(name) for name in meals],
        fn.peak_of(
            [(label, F.coalesce(c(n), F.lit(0))) for label, n in zip(("Breakfast", "Lunch", "Dinner"), meals)]
        ).alias("peak_meal_period"),
    )


def order_history(orders: DataFrame, run: Run) -> DataFrame:
    """Per customer: orders, spending, pace and habits.

    Orders are reduced to one row each before they are added up per customer: every conditional
    distinct count is then a plain sum of flags. Both steps combine in the map tasks, so a
    customer with very many orders is no burden to a single task.
    """
    day = F.to_date("order_timestamp")
    recent = day >= run.days_ago(rules.RECENT_DAYS)
    total = c("order_total")

    def any_row(condition: Column) -> Column:
        return F.max(F.when(condition, 1).otherwise(0))

    per_order = (
        orders.where(c("customer_id").isNotNull())
        .groupBy("customer_id", "order_id")
        .agg(
            F.sum(total).alias("spent"),
            F.count(total).alias("rows"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            any_row(c("order_channel") == "Mobile App").alias("mobile"),
            any_row(c("meal_period") == "Lunch").alias("lunch"),
            any_row(c("discount_percentage") > 0).alias("discounted"),
            any_row(recent).alias("recent"),
            F.sum(F.when(recent, total).otherwise(0)).alias("spent_recently"),
        )
    )
    per_customer = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("spent").alias("total_spent"),
        (F.sum("spent").cast("double") / F.nullif(F.sum("rows"), F.lit(0))).alias("avg_order_value"),
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.sum("mobile").alias("mobile_orders"),
        F.sum("lunch").alias("lunch_orders"),
        F.sum("discounted").alias("discounted_orders"),
        F.sum("recent").alias("orders_last_90_days"),
        F.sum("spent_recently").alias("spent_last_90_days"),
    )
    return per_customer.withColumns(
        {
            "avg_days_between_orders": average_gap(
                c("first_order_date"), c("last_order_date"), c("total_orders")
            ),
            "days_since_last_order": F.datediff(run.today, c("last_order_date")),
        }
    )


def int_customers_segmented(loyalty: DataFrame, orders: DataFrame, run: Run) -> DataFrame:
    history = order_history(orders, run)
    joined = loyalty.join(history, "customer_id", "left")
    made, spent = c("total_orders"), c("total_spent")

    def or_zero(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)).alias(name)

    def share(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)) * F.lit(100.0) / F.nullif(made, F.lit(0))

    segment = fn.classify(
        rules.SEGMENTS,
        "Occasional",
        recency=c("days_since_last_order"),
        orders=made,
        spent=spent,
        signup=c("days_since_signup"),
    )
    return joined.select(
        *[loyalty[name] for name in loyalty.columns],
        or_zero("total_orders"),
        or_zero("total_spent"),
        or_zero("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "avg_days_between_orders",
        F.coalesce(c("days_since_last_order"), F.lit(rules.NEVER_ORDERED_DAYS))
        .alias("days_since_last_order"),
        or_zero("mobile_orders"),
        or_zero("lunch_orders"),
        or_zero("discounted_orders"),
        or_zero("orders_last_90_days"),
        or_zero("spent_last_90_days"),
        lifetime_value(spent, c("avg_order_value"), made, c("avg_days_between_orders"), F.lit(0.0))
        .alias("estimated_lifetime_value"),
        segment.alias("customer_segment"),
        fn.band(share("mobile_orders"), ">=", rules.DIGITAL_SHARE_MIN, "Traditional")
        .alias("digital_engagement_level"),
        fn.band(share("discounted_orders"), ">=", rules.DISCOUNT_SHARE_MIN, "Low Price Sensitivity")
        .alias("price_sensitivity"),
        fn.flag(c("orders_last_90_days") > 0).alias("is_active_customer"),
    )
