"""Gold marts.

All four aggregate the facts by surrogate keys first and fetch dimension attributes for the much
smaller result: the keys determine the attributes, so the groups are the same. Order ids may repeat
in the facts of a first load, so orders are counted distinct: ``key_flags`` marks one row of each order (any row where
the run knows that no id repeats), and the counts become sums. Distinct members, modes and medians are taken from rows that have been added
up to (group, member) before. Nothing is computed while a mart is composed; how a dimension is joined is decided
at run time, by its size in bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.operators.counts import key_flags, weighted_mode
from layercake.operators.windows import (
    first_by,
    lag_by,
    lag_growth,
    partition_avg,
    rank_by,
    rolling_avg,
)
from layercake.plans.intermediate import average_gap, lifetime_value
from layercake.plans.run import Run

c = F.col
WEEK = 7
# How a mart puts a step apart, given its rows and a name: as it is, or written, so that the shuffles up to it can go.
Apart = Callable[[DataFrame, str], DataFrame]


def _as_is(rows: DataFrame, name: str) -> DataFrame:
    return rows


def _average(total: str, number: str) -> Column:
    return F.sum(total).cast("double") / F.nullif(F.sum(number), F.lit(0))


_SERIES = ["truck_sk", "location_sk"]


def daily_sales_totals(orders: DataFrame, run: Run) -> DataFrame:
    """Sales per day, truck and location, from the orders alone."""
    group = ["order_date_sk", "truck_sk", "location_sk"]
    meal = c("meal_period")
    counts = {
        "total_orders": None,
        "mobile_orders": c("order_channel") == "Mobile App",
        "walkin_orders": c("order_channel") == "Walk-up",
        "breakfast_orders": meal == "Breakfast",
        "lunch_orders": meal == "Lunch",
        "dinner_orders": meal == "Dinner",
        "discounted_orders": c("discount_percentage") > 0,
    }
    return key_flags(orders, group, "order_id", counts, run.unique_orders).groupBy(*group).agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum("order_total").alias("total_revenue"),
        F.sum("total_cost_of_goods").alias("total_cost_of_goods"),
        F.sum("order_profit").alias("total_profit"),
        fn.mean(c("order_total")).alias("avg_order_value"),
        F.countDistinct("customer_sk").alias("unique_customers"),
        F.avg("processing_time_minutes").alias("avg_processing_time_minutes"),
        F.sum("line_item_count").alias("total_line_items"),
        F.sum("total_items_ordered").alias("total_items_sold"),
        F.avg("line_item_count").alias("avg_items_per_order"),
    )


def daily_sales_of(totals: DataFrame, dates: DataFrame, trucks: DataFrame, locations: DataFrame, run: Run) -> DataFrame:
    """The mart from its totals: attributes, seven-row trends and ranks within the day."""
    truck = trucks.select(
        "truck_sk", "country_name", c("primary_city").alias("city_name"), "truck_status", "is_electric_vehicle"
    )
    place = locations.select("location_sk", "location_type", "estimated_foot_traffic")
    days = F.broadcast(dates.select(c("date_sk").alias("order_date_sk"), c("date_actual").alias("sales_date")))
    base = (
        totals.join(days, "order_date_sk")
        .join(truck, "truck_sk")
        .join(place, "location_sk", "left")
        .drop("order_date_sk")
    )
    # A series has at most one row per calendar day.
    daily = base.withColumns(
        {
            "profit_margin_pct": fn.safe_pct(c("total_profit"), c("total_revenue")),
            "revenue_7day_avg": rolling_avg(_SERIES, "sales_date", "total_revenue", WEEK),
            "orders_7day_avg": rolling_avg(_SERIES, "sales_date", "total_orders", WEEK),
            "revenue_prev_week": lag_by(_SERIES, "sales_date", "total_revenue", WEEK),
            "orders_prev_week": lag_by(_SERIES, "sales_date", "total_orders", WEEK),
        }
    )
    ranked = rank_by(
        daily,
        ["sales_date"],
        {
            "daily_revenue_rank": "total_revenue",
            "daily_order_rank": "total_orders",
            "daily_profit_rank": "total_profit",
        },
        _SERIES,
    )
    grown = ranked.withColumns(
        {
            "revenue_wow_growth_pct": lag_growth(c("total_revenue"), c("revenue_prev_week")),
            "orders_wow_growth_pct": lag_growth(c("total_orders"), c("orders_prev_week")),
        }
    )
    return run.audited(grown)


def agg_daily_sales(
    orders: DataFrame,
    dates: DataFrame,
    trucks: DataFrame,
    locations: DataFrame,
    run: Run,
) -> DataFrame:
    """Sales per day, truck and location, ranked within the day, with seven-row trends."""
    return daily_sales_of(daily_sales_totals(orders, run), dates, trucks, locations, run)


_HOURS = {f"{label.lower()}_orders": hours for hours, label in rules.MEAL_HOURS}


def location_totals(orders: DataFrame, run: Run) -> DataFrame:
    """Sales per location and day, from the orders alone."""
    group = ["location_sk", "order_date_sk"]
    hour = c("order_hour")
    counts = {"daily_orders": None, **{name: hour.between(*hours) for name, hours in _HOURS.items()}}
    known = orders.where(c("location_sk") != rules.UNKNOWN_KEY).withColumns(
        {"truck": fn.packed_key(c("truck_sk")), "customer": fn.packed_key(c("customer_sk"))}
    ).drop("truck_sk", "customer_sk")
    served_by = key_flags(known, group, "order_id", counts, run.unique_orders).groupBy(*group, "truck", "customer").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum("order_total").alias("revenue"),
        F.count("order_total").alias("valued"),
        F.sum("processing_time_minutes").alias("minutes"),
        F.count("processing_time_minutes").alias("timed"),
    ).repartition(*group)
    # One row of every truck and customer of a group is marked, so that their distinct numbers are sums as well.
    marked = key_flags(key_flags(served_by, group, "truck", {"trucks_served": None}), group, "customer", {"unique_customers": None})
    return marked.groupBy(*group).agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum("revenue").alias("daily_revenue"),
        F.sum("trucks_served").alias("trucks_served"),
        F.sum("unique_customers").alias("unique_customers"),
        _average("revenue", "valued").alias("avg_order_value"),
        _average("minutes", "timed").alias("avg_processing_time"),
    )


def location_insights_of(totals: DataFrame, dates: DataFrame, locations: DataFrame, run: Run) -> DataFrame:
    """The mart from its totals: against the location's month and season."""
    place = locations.select(
        "location_sk", "location_name", "city_name", "country_name", "location_type",
        "estimated_foot_traffic", "business_potential_score",
    )
    days = F.broadcast(
        dates.select(
            c("date_sk").alias("order_date_sk"),
            c("date_actual").alias("analysis_date"),
            "day_of_week_name",
            "is_weekend",
            fn.normalize(c("month_number"), rules.SEASONS, "Fall").alias("season"),
        )
    )
    served = c("trucks_served")
    base = (
        totals.join(days, "order_date_sk")
        .join(place, "location_sk", "left")
        .withColumns(
            {
                "revenue_per_truck": fn.safe_ratio(c("daily_revenue"), served),
                "orders_per_truck": fn.safe_ratio(c("daily_orders"), served),
                "peak_hour_start": fn.peak_of([(rules.PEAK_WINDOWS[m][0], c(m)) for m in _HOURS]),
                "peak_hour_end": fn.peak_of([(rules.PEAK_WINDOWS[m][1], c(m)) for m in _HOURS]),
                "_month": fn.month_of(c("analysis_date")),
            }
        )
    )
    # A location has at most one row per calendar day, so each of these groups is a short series.
    month, where, day = ["location_sk", "_month"], ["location_sk"], "analysis_date"
    busiest = [c("daily_revenue").desc_nulls_first(), c(day).asc()]
    base = base.withColumns(
        {
            "busiest_day_of_week": first_by(month, busiest, "day_of_week_name"),
            "avg_weekend_revenue": partition_avg(month, "daily_revenue", c("is_weekend")),
            "avg_weekday_revenue": partition_avg(month, "daily_revenue", ~c("is_weekend")),
            "revenue_7day_avg": rolling_avg(where, day, "daily_revenue", WEEK),
            "orders_7day_avg": rolling_avg(where, day, "daily_orders", WEEK),
            "seasonal_avg_revenue": partition_avg(["location_sk", "season"], "daily_revenue"),
        }
    )
    ranked = rank_by(
        base,
        [day],
        {"daily_revenue_rank": "daily_revenue", "efficiency_rank": "revenue_per_truck"},
        ["location_sk"],
    )
    season = c("seasonal_avg_revenue")
    potential = [
        (c("revenue_7day_avg") >= season * F.lit(ratio).cast("decimal(2,1)"), score)
        for ratio, score in rules.POTENTIAL_RATIO_MIN
    ]
    final = ranked.select(
        "location_sk",
        "analysis_date",
        "location_name",
        "city_name",
        "country_name",
        "location_type",
        "estimated_foot_traffic",
        "business_potential_score",
        "daily_orders",
        "daily_revenue",
        "trucks_served",
        "unique_customers",
        "avg_order_value",
        "revenue_per_truck",
        "orders_per_truck",
        "peak_hour_start",
        "peak_hour_end",
        "busiest_day_of_week",
        "avg_weekend_revenue",
        "avg_weekday_revenue",
        "daily_revenue_rank",
        "efficiency_rank",
        "revenue_7day_avg",
        "orders_7day_avg",
        "seasonal_avg_revenue",
        fn.safe_ratio(c("avg_weekend_revenue"), c("avg_weekday_revenue"))
        .alias("weekend_vs_weekday_ratio"),
        fn.safe_pct(c("daily_revenue"), c("business_potential_score")).alias("foot_traffic_score"),
        fn.first_match(potential, 50).alias("revenue_potential_score"),
        fn.band(c("daily_revenue_rank"), "<=", rules.LOCATION_RANK_MAX, "Underperforming")
        .alias("location_performance_category"),
    )
    return run.audited(final)


def agg_location_insights(
    orders: DataFrame,
    dates: DataFrame,
    locations: DataFrame,
    trucks: DataFrame,
    run: Run,
) -> DataFrame:
    """Sales per location and day, against the location's month and season."""
    return location_insights_of(location_totals(orders, run), dates, locations, run)


_CHANNEL_PARTS = {"mobile_quantity": "Mobile App", "walkin_quantity": "Walk-up"}
_MEAL_PARTS = {f"{meal.lower()}_quantity": meal for meal in ("Breakfast", "Lunch", "Dinner")}


def _meeting(details: DataFrame, orders: DataFrame) -> str:
    """What lines and orders meet on: the id where the lines carry it, else the surrogate key."""
    return "order_id" if "order_id" in details.columns and "order_id" in orders.columns else "order_sk"


def _member(rows: DataFrame, name: str) -> tuple[Column, Column]:
    """A member of a dimension, and whether it is known: by its id where the rows carry it, else by its packed surrogate key."""
    if f"{name}_id" in rows.columns:
        return c(f"{name}_id"), c(f"{name}_id").isNotNull()
    return fn.packed_key(c(f"{name}_sk")), c(f"{name}_sk") != rules.UNKNOWN_KEY


def menu_totals(details: DataFrame, orders: DataFrame, trucks: DataFrame, run: Run) -> DataFrame:
    """Sales per day and item, by the item's surrogate key."""
    totals = menu_item_totals(details, orders, trucks, run)
    if "menu_item_sk" in totals.columns:
        return totals
    rest = totals.columns[2:]
    return totals.select("order_date_sk", fn.surrogate_key(c("menu_item_id")).alias("menu_item_sk"), *rest)


def menu_item_totals(details: DataFrame, orders: DataFrame, trucks: DataFrame, run: Run) -> DataFrame:
    """Sales per day and item, by the item's id where the lines carry it, else by its surrogate key.

    The facts meet without the lines of unknown orders, and one line of every order, day and item is marked there. The lines
    are then shuffled once, by day and item: first rows of each customer and truck are marked where they sort
    together, and everything is summed in that order. Members travel as ids or packed keys, conditions as bits of one number.
    """
    on = _meeting(details, orders)
    item, known = _member(details, "menu_item")
    lines = details.where(known & (c("order_sk") != rules.UNKNOWN_KEY)).select(
        on, item.alias("item"), "quantity", "line_total", "line_cost_of_goods", "line_profit", "unit_price",
        "line_discount_amount",
    )
    parts = {name: c("order_channel") == channel for name, channel in _CHANNEL_PARTS.items()}
    parts |= {name: c("meal_period") == meal for name, meal in _MEAL_PARTS.items()}
    bits = {name: 1 << n for n, name in enumerate(parts)}
    customer, _ = _member(orders, "customer")
    # Trucks meet the orders before the lines do: what follows then stays where the lines met their orders.
    heads = orders.select(
        on, "order_date_sk", fn.packed_key(c("truck_sk")).alias("truck"), customer.alias("customer"),
        sum((F.when(parts[name], bit).otherwise(0) for name, bit in bits.items()), F.lit(0)).alias("_parts"),
    ).join(trucks.select(fn.packed_key(c("truck_sk")).alias("truck"), "truck_id"), "truck").drop("truck")
    group = ["order_date_sk", "item"]
    sold = key_flags(lines.join(heads, on), group, on, {"orders": None}).drop(on).repartition(*group)
    marked = key_flags(key_flags(sold, group, "truck_id", {"_truck": None}), group, "customer", {"_customer": None})
    # Orders of unknown customers count as one customer, which has a surrogate key but no id.
    unknown = F.max(F.when(c("customer").isNull(), 1).otherwise(0)) if "customer_id" in orders.columns else F.lit(0)
    totals = marked.groupBy(*group).agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("orders").alias("orders_containing_item"),
        F.sum("line_total").alias("total_revenue"),
        F.sum("line_cost_of_goods").alias("total_cost_of_goods"),
        F.sum("line_profit").alias("total_profit"),
        fn.mean(c("unit_price")).alias("avg_selling_price"),
        F.sum("line_discount_amount").alias("total_discounts_given"),
        F.sum("_truck").alias("trucks_selling_item"),
        (F.sum("_customer") + unknown).alias("unique_customers"),
        *[F.sum(F.when(c("_parts").bitwiseAND(bit) != 0, c("quantity")).otherwise(0)).alias(name) for name, bit in bits.items()],
    )
    by_id = "menu_item_id" in details.columns
    named = c("item").alias("menu_item_id") if by_id else fn.unpacked_key(c("item")).alias("menu_item_sk")
    return totals.select("order_date_sk", named, *[name for name in totals.columns if name not in group])


_ITEM_ATTRIBUTES = (
    "menu_item_name", "truck_brand_name", "item_category", "item_subcategory", "sale_price_usd", "cost_of_goods_usd",
    "is_vegetarian", "is_vegan", "is_gluten_free", "menu_matrix_classification",
)
_ITEM_COLUMNS = ("menu_item_sk", "menu_item_id", *_ITEM_ATTRIBUTES)


def menu_performance_of(totals: DataFrame, dates: DataFrame, items: DataFrame, run: Run) -> DataFrame:
    """The mart from its totals: attributes and ranks within the day and the category."""
    by_id = "menu_item_id" in totals.columns
    key = c("menu_item_id") if by_id else fn.packed_key(c("menu_item_sk"))
    item = items.select(key.alias("_item"), *_ITEM_ATTRIBUTES)
    days = F.broadcast(
        dates.select(c("date_sk").alias("order_date_sk"), c("date_actual").alias("analysis_date"))
    )
    sold = totals.withColumn("_item", key).drop("menu_item_id" if by_id else "menu_item_sk")
    base = sold.join(days, "order_date_sk").join(item, "_item").drop("order_date_sk")
    if by_id:
        # Items travel as ids, and have their keys where the days are ranked. Packed keys sort as their texts do.
        base = base.repartition("analysis_date").withColumn("_item", fn.packed_key(fn.surrogate_key(c("_item"))))
    base = base.withColumn(
        "profit_margin_pct", fn.safe_pct(c("total_profit"), c("total_revenue"), places=8)
    )
    ranked = rank_by(
        base,
        ["analysis_date"],
        {
            "popularity_rank": "total_quantity_sold",
            "revenue_rank": "total_revenue",
            "profit_rank": "total_profit",
        },
        ["_item"],
    )
    ranked = rank_by(
        ranked,
        ["analysis_date", "item_category"],
        {"category_popularity_rank": "total_quantity_sold"},
        ["_item"],
    )
    mobile, walkin = c("mobile_quantity"), c("walkin_quantity")
    labelled = ranked.withColumns(
        {
            "peak_meal_period": fn.peak_of(
                [(m, c(f"{m.lower()}_quantity")) for m in ("Breakfast", "Lunch", "Dinner")]
            ),
            "channel_preference": fn.first_match(
                [(mobile > walkin, "Mobile Preferred"), (walkin > mobile, "Walk-up Preferred")],
                "Balanced",
            ),
            "performance_classification": fn.classify(
                rules.ITEM_CLASSES,
                "Standard",
                sold=c("total_quantity_sold"),
                margin=c("profit_margin_pct"),
            ),
        }
    )
    named = fn.unpacked_key(c("_item")).alias("menu_item_sk")
    return run.audited(labelled.select(named, *[name for name in labelled.columns if name != "_item"]))


def agg_menu_performance(
    details: DataFrame,
    orders: DataFrame,
    dates: DataFrame,
    items: DataFrame,
    trucks: DataFrame,
    run: Run,
    apart: Apart = _as_is,
) -> DataFrame:
    """Sales per day and item, ranked within the day and the category."""
    totals = apart(menu_item_totals(details, orders, trucks, run), "menu_totals")
    named = [name for name in _ITEM_COLUMNS if name in items.columns]
    return menu_performance_of(totals, dates, apart(items.select(*named), "menu_items"), run)


def _weights(rows: DataFrame, by: str, *columns: str) -> DataFrame:
    """Add ``_of_<column>``: how many rows of the facts have the group's value of that column."""
    return rows.withColumns(
        {f"_of_{name}": F.sum("_rows").over(Window.partitionBy(by, name)) for name in columns}
    )


def _customer_key(orders: DataFrame) -> Column:
    """The surrogate key of a ``customer`` as ``_member`` of the orders gives it."""
    return fn.surrogate_key(c("customer")) if "customer_id" in orders.columns else fn.unpacked_key(c("customer"))


def _transactions(orders: DataFrame, dates: DataFrame, trucks: DataFrame, locations: DataFrame, run: Run):
    """Order history per customer key, by way of one row per customer, location and truck."""
    day, total, channel, meal = c("date_actual"), c("order_total"), c("order_channel"), c("meal_period")
    recent = day >= run.days_ago(rules.RECENT_DAYS)
    days = F.broadcast(dates.select(c("date_sk").alias("order_date_sk"), "date_actual"))
    counts = {
        "total_orders": None,
        "orders_last_90_days": recent,
        "mobile_orders": channel == "Mobile App",
        "walkin_orders": channel == "Walk-up",
        "online_orders": channel == "Online",
        "breakfast_orders": meal == "Breakfast",
        "lunch_orders": meal == "Lunch",
        "dinner_orders": meal == "Dinner",
        "discounted_orders": c("discount_percentage") > 0,
    }
    averaged = {
        "avg_order_value": "order_total",
        "avg_discount_percentage": "discount_percentage",
        "avg_items_per_order": "line_item_count",
        "avg_processing_time": "processing_time_minutes",
    }
    customer, is_known = _member(orders, "customer")
    keys = {
        "customer": customer, "location": fn.packed_key(c("location_sk")), "truck": fn.packed_key(c("truck_sk")),
    }
    known = orders.where(is_known).select(
        "order_id", "order_date_sk", "order_total", "order_channel", "meal_period", "discount_percentage",
        "line_item_count", "processing_time_minutes", *[key.alias(name) for name, key in keys.items()],
    ).join(days, "order_date_sk").drop("order_date_sk")
    visits = key_flags(known, ["customer"], "order_id", counts, run.unique_orders).groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in counts],
        *[F.sum(column).alias(f"_sum_{name}") for name, column in averaged.items()],
        *[F.count(column).alias(f"_n_{name}") for name, column in averaged.items()],
        F.sum(F.when(recent, total).otherwise(0)).alias("spent_last_90_days"),
        F.min(day).alias("first_order_date"),
        F.max(day).alias("last_order_date"),
        F.count("*").alias("_rows"),
    )
    cities = trucks.select(fn.packed_key(c("truck_sk")).alias("truck"), "primary_city")
    places = locations.select(fn.packed_key(c("location_sk")).alias("location"), "location_type")
    placed = visits.join(cities, "truck", "left").join(places, "location", "left").repartition("customer")
    # One row of every place and truck of a customer is marked, so that their distinct numbers are sums as well.
    for name in ("location", "truck"):
        placed = key_flags(placed, ["customer"], name, {f"_{name}s": None})
    summary = _weights(placed, "customer", "primary_city", "location_type").groupBy("customer").agg(
        *[F.sum(name).alias(name) for name in counts],
        F.sum("_sum_avg_order_value").alias("total_spent"),
        *[_average(f"_sum_{name}", f"_n_{name}").alias(name) for name in averaged],
        F.sum("spent_last_90_days").alias("spent_last_90_days"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.sum("_locations").alias("unique_locations_visited"),
        F.sum("_trucks").alias("unique_trucks_visited"),
        weighted_mode(c("primary_city"), c("_of_primary_city")).alias("preferred_city"),
        weighted_mode(c("location_type"), c("_of_location_type")).alias("preferred_location_type"),
    )
    named = summary.withColumn("customer_sk", _customer_key(orders)).drop("customer")
    return named.withColumns(
        {
            "avg_days_between_orders": average_gap(
                c("first_order_date"), c("last_order_date"), c("total_orders")
            ),
            "days_since_last_order": F.datediff(run.today, c("last_order_date")),
        }
    )


def customer_tastes(orders: DataFrame, details: DataFrame, items: DataFrame) -> DataFrame:
    """Favourite categories and prices per customer key, by way of one row per customer, item and price."""
    on = _meeting(details, orders)
    key, _ = _member(details, "menu_item")
    customer, is_known = _member(orders, "customer")
    item = items.select(
        key.alias("item"), "item_category", "item_subcategory", "truck_brand_name",
        "is_vegetarian", "is_vegan", "is_gluten_free",
    )
    buyers = orders.where(is_known).select(on, customer.alias("customer"))
    lines = details.where(c("order_sk") != rules.UNKNOWN_KEY).select(on, key.alias("item"), "quantity", "unit_price")
    bought = (
        lines.join(buyers, on).groupBy("customer", "item", "unit_price")
        .agg(F.sum("quantity").alias("quantity"), F.count("*").alias("_rows"))
        .withColumn("_prices", c("unit_price") * c("_rows"))
        .withColumn("_priced", F.when(c("unit_price").isNotNull(), c("_rows")).otherwise(0))
        .join(item, "item")
        .repartition("customer")
    )

    def of_diet(name: str) -> Column:
        return F.sum(F.when(c(name), c("quantity")).otherwise(0))

    labels = {
        "favorite_category": "item_category",
        "favorite_subcategory": "item_subcategory",
        "favorite_brand": "truck_brand_name",
    }
    tastes = _weights(bought, "customer", *labels.values()).groupBy("customer").agg(
        *[weighted_mode(c(column), c(f"_of_{column}")).alias(name) for name, column in labels.items()],
        of_diet("is_vegetarian").alias("vegetarian_items_ordered"),
        of_diet("is_vegan").alias("vegan_items_ordered"),
        of_diet("is_gluten_free").alias("gluten_free_items_ordered"),
        F.sum("quantity").alias("total_items_ordered"),
        _average("_prices", "_priced").alias("avg_item_price_preference"),
        F.percentile("unit_price", F.lit(0.5), c("_rows")).alias("median_item_price_preference"),
    )
    named = _customer_key(orders).alias("customer_sk")
    return tastes.select(named, *[name for name in tastes.columns if name != "customer"])


def agg_customer_360(
    customers: DataFrame,
    orders: DataFrame,
    details: DataFrame,
    trucks: DataFrame,
    locations: DataFrame,
    items: DataFrame,
    dates: DataFrame,
    run: Run,
    apart: Apart = _as_is,
) -> DataFrame:
    """One row per customer: history, tastes, value and risk."""
    history = apart(_transactions(orders, dates, trucks, locations, run), "history")
    tastes = customer_tastes(orders, details, items)
    joined = customers.join(history, "customer_sk", "left").join(tastes, "customer_sk", "left")

    def or_zero(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)).alias(name)

    def count_of(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0))

    mobile, walkin, online = (count_of(f"{k}_orders") for k in ("mobile", "walkin", "online"))
    recency, made = c("days_since_last_order"), c("total_orders")
    eaten = c("total_items_ordered")
    risk = F.when(recency.isNull(), 1.0).otherwise(fn.band(recency, "<=", rules.CHURN_RISK_MAX, 0.95))
    final = joined.select(
        "customer_sk",
        "customer_id",
        "customer_name",
        "city_name",
        "country_name",
        "age_group",
        "gender",
        "marital_status",
        "sign_up_date",
        "customer_segment",
        "digital_engagement_level",
        "price_sensitivity",
        "customer_value_tier",
        or_zero("total_orders"),
        or_zero("total_spent"),
        or_zero("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.coalesce(recency, F.lit(rules.NEVER_ORDERED_DAYS)).alias("days_since_last_order"),
        "avg_days_between_orders",
        or_zero("orders_last_90_days"),
        or_zero("spent_last_90_days"),
        *[or_zero(f"{k}_orders") for k in ("mobile", "walkin", "breakfast", "lunch", "dinner")],
        "favorite_category",
        "favorite_subcategory",
        "favorite_brand",
        "preferred_city",
        "preferred_location_type",
        or_zero("unique_locations_visited"),
        or_zero("unique_trucks_visited"),
        or_zero("discounted_orders"),
        or_zero("avg_discount_percentage"),
        or_zero("avg_items_per_order"),
        or_zero("avg_processing_time"),
        fn.safe_pct(c("vegetarian_items_ordered"), eaten).alias("vegetarian_preference_pct"),
        fn.safe_pct(c("vegan_items_ordered"), eaten).alias("vegan_preference_pct"),
        lifetime_value(
            c("total_spent"), c("avg_order_value"), made, c("avg_days_between_orders"),
            c("estimated_lifetime_value"),
        ).alias("calculated_lifetime_value"),
        risk.alias("churn_risk_score"),
        fn.flag(c("orders_last_90_days") > 0).alias("is_active_customer"),
        fn.classify(
            rules.JOURNEY, "At Risk", orders=made, recency=recency, gap=c("avg_days_between_orders")
        ).alias("customer_journey_stage"),
        fn.first_match(
            [
                (mobile > walkin + online, "Mobile Dominant"),
                (walkin > mobile + online, "Walk-up Dominant"),
                (online > mobile + walkin, "Online Dominant"),
            ],
            "Multi-Channel",
        ).alias("channel_preference"),
        fn.peak_of([(m, count_of(f"{m.lower()}_orders")) for m in ("Breakfast", "Lunch", "Dinner")])
        .alias("preferred_meal_period"),
    )
    return run.audited(final)
