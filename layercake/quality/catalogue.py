"""The declared data tests per model, put together from the shapes that recur."""

from __future__ import annotations

from typing import Any

from layercake import rules
from layercake.quality.checks import Rule


def key(*columns: str) -> list[Rule]:
    return [Rule(c, test) for c in columns for test in ("unique", "not_null")]


def present(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def labels(column: str, values: Any, required: bool = False) -> list[Rule]:
    return [*(present(column) if required else []), Rule(column, "accepted_values", values=tuple(values))]


def flags(*columns: str) -> list[Rule]:
    return [rule for c in columns for rule in labels(c, (True, False), required=True)]


def within(
    column: str, low: Any = None, high: Any = None, required: bool = False, known: bool = False
) -> list[Rule]:
    """``known`` restricts the test to non-NULL values explicitly, as declared."""
    where = f"{column} IS NOT NULL" if known else None
    return [
        *(present(column) if required else []),
        Rule(column, "accepted_range", low=low, high=high, where=where),
    ]


def parent(column: str, model: str, known: bool = True, required: bool = False) -> list[Rule]:
    """``known`` leaves out the unknown member."""
    where = f"{column} != '{rules.UNKNOWN_KEY}'" if known else None
    return [
        *(present(column) if required else []),
        Rule(column, "relationships", parent=model, field=column, where=where),
    ]


def holds(name: str, expression: str, where: str | None = None, severity: str = "error") -> list[Rule]:
    return [Rule(name, "expression_is_true", expression=expression, where=where, severity=severity)]


def _band_labels(limits: list, rest: str) -> list:
    return [label for _, label in limits] + [rest]


def _rule_labels(table: list, rest: Any) -> list:
    return list(dict.fromkeys([label for label, _ in table] + [rest]))


CHANNEL_LABELS = [*rules.CHANNELS, "Other"]
MEAL_LABELS = [label for _, label in rules.MEAL_HOURS] + ["Late Night"]
SEGMENT_LABELS = _rule_labels(rules.SEGMENTS, "Occasional")
THREE_MEALS = ["Breakfast", "Lunch", "Dinner"]


def _balance(tolerance: str) -> str:
    return f"abs(order_total - (order_amount + order_tax_amount - order_discount_amount)) <= {tolerance}"


def _profit_is_rest(total: str, revenue: str, cost: str, tolerance: str) -> str:
    return f"abs({total} - ({revenue} - {cost})) <= {tolerance}"


_cost_known = "total_cost_of_goods IS NOT NULL"

# Declared statements, as they are declared.
_TIER_MATCHES = (
    "(customer_value_tier = 'High Value' AND estimated_lifetime_value >= 500) OR "
    "(customer_value_tier = 'Medium Value' AND estimated_lifetime_value >= 200 AND estimated_lifetime_value < 500) OR "
    "(customer_value_tier = 'Low Value' AND estimated_lifetime_value >= 50 AND estimated_lifetime_value < 200) OR "
    "(customer_value_tier = 'Minimal Value' AND estimated_lifetime_value < 50)"
)
_SCORE_MATCHES = (
    "(location_type = 'Downtown' AND estimated_foot_traffic = 'High' AND business_potential_score = 95) OR "
    "(location_type = 'Business District' AND estimated_foot_traffic = 'High' AND business_potential_score = 90) OR "
    "business_potential_score IN (60, 70, 75, 80, 85)"
)
_PROFILE_MATCHES = (
    "(profile_completeness = 'Complete Profile' AND has_complete_name = TRUE AND has_valid_email = TRUE) OR "
    "(profile_completeness = 'Basic Profile' AND has_complete_name = TRUE AND has_valid_email = FALSE) OR "
    "(profile_completeness = 'Incomplete Profile' AND has_complete_name = FALSE)"
)

# Which tests each model declares, with their limits.
RULES: dict[str, list[Rule]] = {
    "stg_pos_order_headers": [
        *key("order_id"),
        *within("order_total", 0, 1000, required=True),
        *labels("order_channel", CHANNEL_LABELS),
        *labels("meal_period", MEAL_LABELS),
        *holds("order_balances", _balance("0.01"), severity="warn"),
        *holds("processing_time_plausible",
               "processing_time_minutes IS NULL OR processing_time_minutes BETWEEN 0 AND 120"),
    ],
    "stg_pos_order_details": [
        *key("order_detail_id"),
        *parent("order_id", "stg_pos_order_headers", known=False, required=True),
        *present("menu_item_id"),
        *within("quantity", 1, 99, required=True),
        *within("unit_price", 0, 100, required=True),
        *flags("is_valid_line_item"),
        *holds("net_not_negative", "net_line_total >= 0"),
        *holds("price_consistent", "price_quantity_consistent OR NOT is_valid_line_item", severity="warn"),
    ],
    "int_orders_enriched": [
        *key("order_id"),
        *within("line_item_count", 1, 50, required=True),
        *within("total_items_ordered", 1, required=True),
        *within("order_profit_margin_pct", -100, 100),
        *labels("order_size_category", _rule_labels(rules.ORDER_SIZES, "Extra Large")),
        *labels("service_speed_category", _band_labels(rules.SERVICE_SPEED_MAX, "Very Slow")),
        *labels("revenue_category", _band_labels(rules.REVENUE_BELOW, "Premium Value")),
        *holds("lines_add_up", "abs(calculated_order_total - order_total) <= 0.05", severity="warn"),
        *holds("categories_within_lines", "category_count <= line_item_count"),
    ],
    "int_menu_profitability": [
        *key("menu_item_id"),
        *labels("sales_performance_tier", _band_labels(rules.SALES_TIER_MIN, "New/Inactive")),
        *labels("profitability_tier", _band_labels(rules.MARGIN_TIER_MIN, "Unprofitable")),
        *labels("trend_status", [label for label, _ in rules.TREND] + ["Inactive"]),
        *labels("peak_meal_period", [*THREE_MEALS, "No Clear Peak"]),
        *within("actual_profit_margin_pct", -100, 100),
        *holds("profit_adds_up", "total_profit = total_revenue - total_quantity_sold * cost_of_goods_usd",
               where="total_quantity_sold > 0"),
        *holds("recent_within_total", "quantity_sold_30_days <= total_quantity_sold"),
    ],
    "int_customers_segmented": [
        *key("customer_id"),
        *labels("customer_segment", SEGMENT_LABELS),
        *labels("digital_engagement_level", _band_labels(rules.DIGITAL_SHARE_MIN, "Traditional")),
        *labels("price_sensitivity", _band_labels(rules.DISCOUNT_SHARE_MIN, "Low Price Sensitivity")),
        *within("estimated_lifetime_value", 0, 10000, required=True),
        *flags("is_active_customer"),
        *holds("vip_meets_limits",
               "customer_segment <> 'VIP' OR "
               "(days_since_last_order <= 30 AND total_orders >= 10 AND total_spent >= 200)"),
        *holds("churned_is_idle",
               "customer_segment <> 'Churned' OR (days_since_last_order > 180 AND NOT is_active_customer)"),
    ],
    "dim_country": [
        *key("country_sk", "country_id"),
        *present("iso_country", "iso_currency"),
        *flags("is_active"),
        *holds("region_named", "region_name IS NOT NULL AND length(trim(region_name)) > 0"),
        *holds("country_code_length", "length(iso_country) = 2"),
        *holds("currency_code_length", "length(iso_currency) = 3"),
    ],
    "dim_city": [
        *key("city_sk", "city_id"),
        *parent("country_sk", "dim_country", known=False, required=True),
        *within("population", 0, 50_000_000, known=True),
        *labels("timezone", [*rules.TIME_ZONES, "UTC"], required=True),
        *holds("city_named", "city_name IS NOT NULL AND length(trim(city_name)) > 0"),
    ],
    "dim_location": [
        *key("location_sk", "location_id"),
        *labels("location_type", [label for _, label in rules.LOCATION_TYPES] + ["Other"]),
        *labels("estimated_foot_traffic", ["High", "Medium", "Low"]),
        *within("business_potential_score", 0, 100, required=True),
        *present("iso_country_code"),
        *holds("score_matches_type", _SCORE_MATCHES),
        *holds("country_code_length", "length(iso_country_code) = 2"),
    ],
    "dim_franchise": [
        *key("franchise_sk", "franchise_id"),
        *labels("profile_completeness",
                ["Complete Profile", "Basic Profile", "Incomplete Profile"], required=True),
        *flags("has_complete_name", "has_valid_email"),
        *holds("profile_matches_flags", _PROFILE_MATCHES),
    ],
    "dim_truck": [
        *key("truck_sk", "truck_id"),
        *parent("franchise_sk", "dim_franchise"),
        *within("sustainability_score", 0, 100, required=True),
        *labels("operational_category", _rule_labels(rules.OPERATIONAL_CATEGORIES, "Inactive"), required=True),
        *within("vehicle_year", 1900, 2030, known=True),
        *flags("is_electric_vehicle"),
        *holds("electric_scores_full", "NOT is_electric_vehicle OR sustainability_score = 100"),
    ],
    "dim_customer": [
        *key("customer_sk", "customer_id"),
        *labels("customer_segment", SEGMENT_LABELS, required=True),
        *labels("customer_value_tier", _band_labels(rules.VALUE_TIER_MIN, "Minimal Value"), required=True),
        *labels("communication_preference",
                [*rules.CONTACT_PREFERENCES, "Traditional Preferred"], required=True),
        *within("estimated_lifetime_value", 0, 10000, required=True),
        *within("age", 13, 120, known=True),
        *holds("tier_matches_value", _TIER_MATCHES),
    ],
    "dim_menu_item": [
        *key("menu_item_sk", "menu_item_id"),
        *within("sale_price_usd", 0.5, 100, required=True),
        *within("cost_of_goods_usd", 0.1, 50, required=True),
        *labels("menu_matrix_classification", _rule_labels(rules.MENU_MATRIX, "Question Mark"), required=True),
        *within("dietary_options_score", 0, 3, required=True),
        *within("calories", 50, 2000, known=True),
        *holds("cost_below_price", "cost_of_goods_usd < sale_price_usd", where="profit_margin_pct > 0"),
    ],
    "fact_order": [
        *key("order_sk", "order_id"),
        *parent("truck_sk", "dim_truck", required=True),
        *parent("customer_sk", "dim_customer"),
        *parent("location_sk", "dim_location"),
        *within("order_total", 0, 1000, required=True),
        *within("order_profit_margin_pct", -100, 100),
        *within("processing_time_minutes", 0, 120, known=True),
        *labels("order_channel", CHANNEL_LABELS, required=True),
        *labels("meal_period", MEAL_LABELS, required=True),
        *holds("order_balances", _balance("0.05"), severity="warn"),
        *holds("profit_is_total_less_cost",
               _profit_is_rest("order_profit", "order_total", "total_cost_of_goods", "0.05"), where=_cost_known),
    ],
    "fact_order_detail": [
        *key("order_detail_sk", "order_detail_id"),
        *parent("order_sk", "fact_order", required=True),
        *parent("menu_item_sk", "dim_menu_item", required=True),
        *within("quantity", 1, 99, required=True),
        *within("unit_price", 0, 100, required=True),
        *within("net_line_total", 0, 500, required=True),
        *within("line_profit_margin_pct", -100, 100),
        *flags("is_valid_line_item"),
        *holds("profit_is_net_less_cost",
               _profit_is_rest("line_profit", "net_line_total", "line_cost_of_goods", "0.01"),
               where="is_valid_line_item"),
        *holds("only_valid_lines", "is_valid_line_item"),
    ],
    "agg_customer_360": [
        *key("customer_sk", "customer_id"),
        *within("total_orders", 0, 10000, required=True),
        *within("total_spent", 0, 100_000, required=True),
        *within("avg_order_value", 0, 500, known=True),
        *within("churn_risk_score", 0, 1, required=True),
        *labels("customer_journey_stage", _rule_labels(rules.JOURNEY, "At Risk"), required=True),
        *labels("channel_preference",
                ["Mobile Dominant", "Walk-up Dominant", "Online Dominant", "Multi-Channel"], required=True),
        *within("vegetarian_preference_pct", 0, 100, required=True),
        *within("calculated_lifetime_value", 0, 50_000, required=True),
        *holds("recent_orders_within_total", "orders_last_90_days <= total_orders"),
        *holds("recent_spending_within_total", "spent_last_90_days <= total_spent"),
    ],
    "agg_daily_sales": [
        *present("sales_date"),
        *parent("truck_sk", "dim_truck", required=True),
        *parent("location_sk", "dim_location"),
        *within("total_orders", 0, 1600, required=True),
        *within("total_revenue", 0, 100_000, required=True),
        *within("profit_margin_pct", -100, 100, required=True),
        *within("daily_revenue_rank", 1, 10_000, required=True),
        *within("revenue_wow_growth_pct", -100, 1000, known=True),
        *within("avg_order_value", 0, 200, known=True),
        *holds("profit_is_revenue_less_cost",
               _profit_is_rest("total_profit", "total_revenue", "total_cost_of_goods", "0.05"),
               where=_cost_known),
        *holds("an_item_per_order", "total_items_sold >= total_orders"),
        *holds("not_in_the_future", "sales_date <= current_date()"),
    ],
    "agg_location_insights": [
        *parent("location_sk", "dim_location", required=True),
        *present("analysis_date"),
        *within("daily_orders", 0, 2000, required=True),
        *within("daily_revenue", 0, 100_000, required=True),
        *within("revenue_per_truck", 0, 100_000, required=True),
        *labels("peak_hour_start", [a for a, _ in rules.PEAK_WINDOWS.values()], required=True),
        *labels("peak_hour_end", [b for _, b in rules.PEAK_WINDOWS.values()], required=True),
        *labels("location_performance_category",
                _band_labels(rules.LOCATION_RANK_MAX, "Underperforming"), required=True),
        *within("weekend_vs_weekday_ratio", 0, 15, known=True),
        *within("foot_traffic_score", 0, 200_000, required=True),
        *holds("peak_ends_after_start", "peak_hour_end > peak_hour_start"),
        *holds("revenue_per_truck_adds_up",
               "trucks_served = 0 OR revenue_per_truck = CAST(daily_revenue AS DOUBLE) / trucks_served",
               where="trucks_served IS NOT NULL"),
        *holds("not_in_the_future", "analysis_date <= current_date()"),
    ],
    "agg_menu_performance": [
        *parent("menu_item_sk", "dim_menu_item", required=True),
        *present("analysis_date"),
        *within("total_quantity_sold", 0, 50_000, required=True),
        *within("total_revenue", 0, 800_000, required=True),
        *within("profit_margin_pct", -100, 100, required=True),
        *within("popularity_rank", 1, 10_000, required=True),
        *labels("peak_meal_period", [*THREE_MEALS, "Even Distribution"], required=True),
        *labels("channel_preference", ["Mobile Preferred", "Walk-up Preferred", "Balanced"], required=True),
        *labels("performance_classification", _rule_labels(rules.ITEM_CLASSES, "Standard"), required=True),
        *within("avg_selling_price", 0, 100, known=True),
        *holds("profit_is_revenue_less_cost",
               _profit_is_rest("total_profit", "total_revenue", "total_cost_of_goods", "0.05"),
               where=_cost_known),
        *holds("an_item_per_order", "orders_containing_item <= total_quantity_sold"),
        *holds("not_in_the_future", "analysis_date <= current_date()"),
    ],
}
