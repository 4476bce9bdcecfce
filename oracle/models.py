"""The models as SQL: joins first, then groups."""

from __future__ import annotations

from layercake import rules
from oracle.sql import (
    AS_OF,
    AS_OF_TS,
    CALENDAR,
    any_word,
    average,
    case,
    case_band,
    case_between,
    case_in,
    case_rules,
    case_words,
    cte,
    initcap,
    key,
    model,
    pct,
    peak,
    text,
)


def code(column: str) -> str:
    return f"upper(trim({column}))"


def full_name(*parts: str) -> str:
    return "trim(concat_ws(' ', " + ", ".join(f"coalesce({initcap(p)}, '')" for p in parts) + "))"


def is_email(column: str) -> str:
    return f"coalesce(regexp_matches({column}, {text(rules.EMAIL_PATTERN)}), false)"


def email(column: str) -> str:
    return f"CASE WHEN {is_email(column)} THEN lower(trim({column})) END"


def digits(column: str) -> str:
    return f"regexp_replace(trim({column}), {text(rules.NON_DIGITS)}, '', 'g')"


def first_row(source: str, key_column: str, order: str) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key_column} ORDER BY {order}) = 1"
    )


# ------------------------------------------------------------------------------------ calendars
_shift = rules.FISCAL_FIRST_MONTH - 1
_holiday = case(
    [(f"month(d) = {m} AND day(d) = {x}", text(n)) for (m, x), n in rules.HOLIDAYS], "NULL"
)
cte("days", "", f"SELECT CAST(range AS DATE) AS d FROM range(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY)")
cte("dim_date", "days", f"""
    SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_sk, d AS date_actual,
        day(d) AS day_of_month, dayofyear(d) AS day_of_year, dayofweek(d) AS day_of_week,
        dayname(d) AS day_of_week_name, week(d) AS week_of_year, month(d) AS month_number,
        monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_short_name,
        quarter(d) AS quarter_number, 'Q' || quarter(d) AS quarter_name, year(d) AS year_number,
        dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
        year(d - INTERVAL {_shift} MONTH) AS fiscal_year,
        quarter(d - INTERVAL {_shift} MONTH) AS fiscal_quarter,
        month(d - INTERVAL {_shift} MONTH) AS fiscal_month,
        {_holiday} IS NOT NULL AS is_holiday, {_holiday} AS holiday_name
    FROM days""")
cte("minutes", "", "SELECT range // 60 AS h, range % 60 AS m FROM range(1440)")
cte("dim_time", "minutes", f"""
    SELECT h * 100 + m AS time_sk, format('{{:02d}}:{{:02d}}:00', h, m) AS time_actual, h AS hour_24,
        CASE WHEN h % 12 = 0 THEN 12 ELSE h % 12 END AS hour_12,
        CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm, m AS minute_number,
        format('{{:02d}}:{{:02d}}', h, m) AS hour_minute,
        {case_between("h", rules.DAY_PARTS, "Night")} AS day_part,
        {case_between("h", rules.MEAL_HOURS, "Off Hours")} AS meal_period
    FROM minutes""")

# -------------------------------------------------------------------------------------- staging
cte("stg_pos_countries", "raw_country", f"""
    SELECT {key("country_id")} AS country_sk, country_id, city_id, city AS city_name,
        city_population AS population,
        {case_in(code("country"), rules.COUNTRY_NAMES, initcap("country"))} AS country_name,
        CASE WHEN length(trim(iso_currency)) = 3 THEN {code("iso_currency")}
            ELSE '{rules.DEFAULT_CURRENCY}' END AS iso_currency,
        CASE WHEN length(trim(iso_country)) = 2 THEN {code("iso_country")} END AS iso_country,
        {case_in("iso_country", rules.REGIONS, "'Other'")} AS region_name, true AS is_valid_record
    FROM raw_country
    WHERE country_id IS NOT NULL AND trim(country) <> '' AND raw_country.iso_country IS NOT NULL""")
cte("stg_pos_franchises", "raw_franchise", f"""
    SELECT franchise_id, {full_name("first_name", "last_name")} AS franchise_owner_name, first_name,
        last_name, {initcap("city")} AS city_name, {initcap("country")} AS country_name,
        {email("e_mail")} AS email, {digits("phone_number")} AS phone_number,
        first_name IS NOT NULL AND last_name IS NOT NULL AS has_complete_name,
        {is_email("e_mail")} AS has_valid_email
    FROM raw_franchise WHERE franchise_id IS NOT NULL""")
cte("stg_pos_locations", "raw_location", f"""
    SELECT location_id, trim(placekey) AS placekey, {initcap("location")} AS location_name,
        {initcap("city")} AS city_name, {initcap("region")} AS region_name,
        {code("iso_country_code")} AS iso_country_code, {initcap("country")} AS country_name,
        {case_words("upper(location)", rules.LOCATION_TYPES, "'Other'")} AS location_type,
        {case_words("upper(location)", rules.FOOT_TRAFFIC, "'Low'")} AS estimated_foot_traffic
    FROM raw_location WHERE location_id IS NOT NULL AND trim(location) <> ''""")
_health = "menu_item_health_metrics_obj"
_nutrients = ", ".join(
    f"CAST(json_extract_string({_health}, '$.{field}') AS BIGINT) AS {column}"
    for column, field in rules.NUTRIENTS.items()
)
_diets = ", ".join(
    f"coalesce(json_extract_string({_health}, '$.{field}') = 'true', false) "
    f"OR {any_word('upper(menu_item_name)', words)} AS {column}"
    for column, (field, words) in rules.DIETS.items()
)
cte("stg_pos_menu", "raw_menu", f"""
    SELECT menu_id, menu_type_id, {initcap("menu_type")} AS menu_type_name,
        {initcap("truck_brand_name")} AS truck_brand_name, menu_item_id,
        {initcap("menu_item_name")} AS menu_item_name,
        {case_in(code("item_category"), rules.CATEGORIES, initcap("item_category"))} AS item_category,
        {initcap("item_subcategory")} AS item_subcategory,
        coalesce(cost_of_goods_usd, 0) AS cost_of_goods_usd,
        coalesce(sale_price_usd, 0) AS sale_price_usd,
        {pct("(sale_price_usd - coalesce(cost_of_goods_usd, 0))", "sale_price_usd", places=8)} AS profit_margin_pct,
        {_nutrients}, {_diets},
        coalesce(sale_price_usd > 0 AND cost_of_goods_usd >= 0
            AND raw_menu.sale_price_usd > raw_menu.cost_of_goods_usd, false) AS has_valid_pricing
    FROM raw_menu WHERE menu_item_id IS NOT NULL AND trim(menu_item_name) <> ''""")
_days_open = f"date_diff('day', truck_opening_date, {AS_OF})"
cte("stg_pos_trucks", "raw_truck", f"""
    SELECT truck_id, menu_type_id, franchise_id, {initcap("primary_city")} AS primary_city,
        {initcap("region")} AS region_name, {code("iso_region")} AS iso_region,
        {initcap("country")} AS country_name, {code("iso_country_code")} AS iso_country_code,
        coalesce(franchise_flag = 1, false) AS is_franchise, year AS vehicle_year,
        {initcap("make")} AS vehicle_make, {initcap("model")} AS vehicle_model,
        coalesce(ev_flag = 1, false) AS is_electric_vehicle, truck_opening_date,
        {case_band(f"year({AS_OF}) - raw_truck.year", "<=", rules.VEHICLE_AGE_MAX, "Legacy")}
            AS vehicle_age_category,
        CASE WHEN truck_opening_date > {AS_OF} THEN 'Planned' WHEN truck_opening_date IS NULL THEN 'Unknown'
            ELSE 'Active' END AS operational_status,
        greatest(coalesce({_days_open}, 0), 0) AS days_in_operation,
        CASE WHEN truck_opening_date > {AS_OF} THEN 'Pre-Launch' ELSE
            {case_band(_days_open, "<=", rules.TRUCK_MATURITY_MAX, "Mature")} END AS truck_maturity
    FROM raw_truck WHERE truck_id IS NOT NULL""")
_age = f"(year({AS_OF}) - year(birthday_date))"
_tenure = f"date_diff('day', sign_up_date, {AS_OF})"
cte("stg_customer_loyalty", "raw_customer_loyalty", f"""
    SELECT customer_id, {initcap("first_name")} AS first_name, {initcap("last_name")} AS last_name,
        {full_name("r.first_name", "r.last_name")} AS customer_name, {initcap("city")} AS city_name,
        {initcap("country")} AS country_name, {code("postal_code")} AS postal_code,
        {case_in(code("r.preferred_language"), rules.LANGUAGES, initcap("r.preferred_language"))}
            AS preferred_language,
        {case_in(code("r.gender"), rules.GENDERS, "'Not specified'")} AS gender,
        {initcap("favourite_brand")} AS favourite_brand,
        {case_in(code("r.marital_status"), rules.MARITAL, "'Not specified'")} AS marital_status,
        coalesce(try_cast(children_count AS BIGINT), 0) AS children_count, sign_up_date, birthday_date,
        {email("e_mail")} AS email, {digits("r.phone_number")} AS phone_number, {_age} AS age,
        CASE WHEN birthday_date IS NULL THEN 'Unknown' ELSE
            {case_band(_age, "<", rules.AGE_GROUP_BELOW, "Boomer+")} END AS age_group,
        {_tenure} AS days_since_signup,
        {case_band(_tenure, "<=", rules.TENURE_MAX, "Veteran")} AS initial_segment,
        r.first_name IS NOT NULL AND r.last_name IS NOT NULL AS has_complete_name,
        {is_email("e_mail")} AS has_valid_email,
        coalesce(birthday_date <= {AS_OF} AND birthday_date >= DATE '{rules.EARLIEST_BIRTHDAY}', false)
            AS has_valid_birthday
    FROM raw_customer_loyalty r WHERE customer_id IS NOT NULL""")
_served = "CAST(nullif(trim(served_ts), '') AS TIMESTAMP)"
cte("stg_pos_order_headers", "raw_order_header", f"""
    SELECT order_id, truck_id, location_id, customer_id, nullif(trim(discount_id), '') AS discount_id,
        shift_id, shift_start_time, shift_end_time,
        {case_in(code("r.order_channel"), rules.CHANNELS, "'Other'")} AS order_channel,
        order_ts AS order_timestamp, {_served} AS served_timestamp,
        coalesce({code("r.order_currency")}, '{rules.DEFAULT_CURRENCY}') AS order_currency,
        coalesce(r.order_amount, 0) AS order_amount,
        coalesce(CAST(r.order_tax_amount AS DECIMAL(10,4)), 0) AS order_tax_amount,
        coalesce(CAST(r.order_discount_amount AS DECIMAL(10,4)), 0) AS order_discount_amount, order_total,
        date_diff('minute', order_ts, {_served}) AS processing_time_minutes,
        coalesce({pct("CAST(r.order_discount_amount AS DECIMAL(10,4))", "r.order_amount")}, 0)
            AS discount_percentage,
        hour(order_ts) AS order_hour, dayofweek(order_ts) AS order_day_of_week,
        {case_between("hour(order_ts)", rules.MEAL_HOURS, "Late Night")} AS meal_period
    FROM raw_order_header r
    WHERE order_id IS NOT NULL AND truck_id IS NOT NULL AND order_ts IS NOT NULL AND r.order_total > 0""")
_given = "try_cast(order_item_discount_amount AS DECIMAL(10,4))"
cte("stg_pos_order_details", "raw_order_detail", f"""
    SELECT order_detail_id, order_id, menu_item_id, nullif(trim(discount_id), '') AS discount_id,
        line_number, least(r.quantity, {rules.MAX_QUANTITY}) AS quantity,
        coalesce(r.unit_price, 0) AS unit_price, coalesce(price, 0) AS line_total,
        coalesce({_given}, 0) AS line_discount_amount,
        CASE WHEN price > 0 THEN CAST(price AS DOUBLE) / r.quantity ELSE r.unit_price END
            AS calculated_unit_price,
        {pct(_given, "price")} AS line_discount_percentage,
        price - coalesce({_given}, 0) AS net_line_total,
        coalesce(r.unit_price >= 0 AND price >= 0, false) AS is_valid_line_item,
        coalesce(abs(price - r.quantity * r.unit_price) <= {rules.PRICE_TOLERANCE}, false)
            AS price_quantity_consistent
    FROM raw_order_detail r
    WHERE order_detail_id IS NOT NULL AND order_id IS NOT NULL AND menu_item_id IS NOT NULL
        AND r.quantity > 0""")

# --------------------------------------------------------------------------------- intermediate
cte("order_lines", "stg_pos_order_details stg_pos_menu", f"""
    SELECT order_id, count(*) AS line_item_count, sum(quantity) AS total_items_ordered,
        sum(net_line_total) AS calculated_order_total, {average("unit_price")} AS avg_item_price,
        sum(line_discount_amount) AS total_line_discounts,
        count(DISTINCT item_category) AS category_count,
        string_agg(DISTINCT item_category, ', ' ORDER BY item_category) AS categories_ordered,
        sum(quantity * cost_of_goods_usd) AS total_cost_of_goods,
        sum(net_line_total) - sum(quantity * cost_of_goods_usd) AS order_profit
    FROM stg_pos_order_details LEFT JOIN stg_pos_menu USING (menu_item_id)
    WHERE is_valid_line_item GROUP BY order_id""")
cte("int_orders_enriched", "stg_pos_order_headers order_lines", f"""
    SELECT h.*, l.* EXCLUDE (order_id),
        {pct("order_profit", "order_total")} AS order_profit_margin_pct,
        {case_rules(rules.ORDER_SIZES, "Extra Large", items="total_items_ordered")} AS order_size_category,
        {case_band("processing_time_minutes", "<=", rules.SERVICE_SPEED_MAX, "Very Slow")}
            AS service_speed_category,
        {case_band("order_total", "<", rules.REVENUE_BELOW, "Premium Value")} AS revenue_category
    FROM stg_pos_order_headers h LEFT JOIN order_lines l ON h.order_id = l.order_id""")
_recent = f"order_timestamp >= {AS_OF_TS} - INTERVAL {rules.MENU_RECENT_DAYS} DAY"
cte("menu_sales", "stg_pos_order_details stg_pos_order_headers", f"""
    SELECT menu_item_id, count(DISTINCT order_id) AS orders_containing_item,
        sum(quantity) AS total_quantity_sold, sum(net_line_total) AS total_revenue,
        {average("unit_price")} AS avg_selling_price, sum(line_discount_amount) AS total_discounts_given,
        sum(quantity) FILTER ({_recent}) AS quantity_sold_30_days,
        sum(net_line_total) FILTER ({_recent}) AS revenue_30_days,
        sum(quantity) FILTER (order_channel = 'Mobile App') AS mobile_sales,
        sum(quantity) FILTER (order_channel = 'Walk-up') AS walkin_sales,
        sum(quantity) FILTER (meal_period = 'Breakfast') AS breakfast_sales,
        sum(quantity) FILTER (meal_period = 'Lunch') AS lunch_sales,
        sum(quantity) FILTER (meal_period = 'Dinner') AS dinner_sales
    FROM stg_pos_order_details JOIN stg_pos_order_headers USING (order_id)
    WHERE is_valid_line_item GROUP BY menu_item_id""")
_counts = [
    "orders_containing_item", "total_quantity_sold", "total_revenue", "total_discounts_given",
    "quantity_sold_30_days", "revenue_30_days", "mobile_sales", "walkin_sales", "breakfast_sales",
    "lunch_sales", "dinner_sales",
]
_profit = "(s.total_revenue - s.total_quantity_sold * b.cost_of_goods_usd)"
_trend = case(
    [(f"coalesce(s.quantity_sold_30_days, 0) > s.total_quantity_sold * {share}", text(label)) for label, share in rules.TREND],
    "'Inactive'",
)
cte("int_menu_profitability", "stg_pos_menu menu_sales", f"""
    SELECT b.*, {", ".join(f"coalesce(s.{n}, 0) AS {n}" for n in _counts)},
        coalesce(s.avg_selling_price, b.sale_price_usd) AS avg_selling_price,
        {_profit} AS total_profit,
        {pct(_profit, "s.total_revenue", "b.profit_margin_pct")} AS actual_profit_margin_pct,
        {case_band("s.total_quantity_sold", ">=", rules.SALES_TIER_MIN, "New/Inactive")}
            AS sales_performance_tier,
        {case_band("b.profit_margin_pct", ">=", rules.MARGIN_TIER_MIN, "Unprofitable")}
            AS profitability_tier,
        {_trend} AS trend_status,
        {peak([(m, f"coalesce(s.{m.lower()}_sales, 0)") for m in ("Breakfast", "Lunch", "Dinner")])}
            AS peak_meal_period
    FROM (SELECT * FROM stg_pos_menu WHERE has_valid_pricing) b
        LEFT JOIN menu_sales s ON b.menu_item_id = s.menu_item_id""")


def lifetime(orders: str, spent: str, average_value: str, gap: str, otherwise: str) -> str:
    return (
        f"CASE WHEN {gap} > 0 THEN {average_value} * ({rules.DAYS_PER_YEAR}.0 / {gap}) * {rules.PROJECTION_YEARS} "
        f"WHEN {orders} > 0 THEN {spent} * {rules.SINGLE_ORDER_FACTOR} ELSE {otherwise} END"
    )


_gap = (
    "CASE WHEN count(DISTINCT order_id) > 1 THEN CAST(date_diff('day', min({0}), max({0})) AS DOUBLE) "
    "/ (count(DISTINCT order_id) - 1) END"
)
_day = "CAST(order_timestamp AS DATE)"
_in_90 = "{0} >= " + f"{AS_OF} - INTERVAL {rules.RECENT_DAYS} DAY"
cte("customer_history", "int_orders_enriched", f"""
    SELECT customer_id, count(DISTINCT order_id) AS total_orders, sum(order_total) AS total_spent,
        {average("order_total")} AS avg_order_value, min({_day}) AS first_order_date,
        max({_day}) AS last_order_date, {_gap.format(_day)} AS avg_days_between_orders,
        date_diff('day', max({_day}), {AS_OF}) AS days_since_last_order,
        count(DISTINCT order_id) FILTER (order_channel = 'Mobile App') AS mobile_orders,
        count(DISTINCT order_id) FILTER (meal_period = 'Lunch') AS lunch_orders,
        count(DISTINCT order_id) FILTER (discount_percentage > 0) AS discounted_orders,
        count(DISTINCT order_id) FILTER ({_in_90.format(_day)}) AS orders_last_90_days,
        sum(order_total) FILTER ({_in_90.format(_day)}) AS spent_last_90_days
    FROM int_orders_enriched GROUP BY customer_id""")
cte("int_customers_segmented", "stg_customer_loyalty customer_history", f"""
    SELECT c.*, coalesce(total_orders, 0) AS total_orders, coalesce(total_spent, 0) AS total_spent,
        coalesce(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
        avg_days_between_orders,
        coalesce(days_since_last_order, {rules.NEVER_ORDERED_DAYS}) AS days_since_last_order,
        coalesce(mobile_orders, 0) AS mobile_orders, coalesce(lunch_orders, 0) AS lunch_orders,
        coalesce(discounted_orders, 0) AS discounted_orders,
        coalesce(orders_last_90_days, 0) AS orders_last_90_days,
        coalesce(spent_last_90_days, 0) AS spent_last_90_days,
        {lifetime("h.total_orders", "h.total_spent", "h.avg_order_value", "h.avg_days_between_orders", "0")}
            AS estimated_lifetime_value,
        {case_rules(rules.SEGMENTS, "Occasional", recency="h.days_since_last_order",
                    orders="h.total_orders", spent="h.total_spent", signup="c.days_since_signup")}
            AS customer_segment,
        {case_band("h.mobile_orders * 100.0 / h.total_orders", ">=", rules.DIGITAL_SHARE_MIN, "Traditional")}
            AS digital_engagement_level,
        {case_band("h.discounted_orders * 100.0 / h.total_orders", ">=", rules.DISCOUNT_SHARE_MIN,
                   "Low Price Sensitivity")} AS price_sensitivity,
        coalesce(h.orders_last_90_days, 0) > 0 AS is_active_customer
    FROM stg_customer_loyalty c LEFT JOIN customer_history h ON c.customer_id = h.customer_id""")

# --------------------------------------------------------------------------------------- dimensions
_country_order = "iso_country, city_id"
cte("dim_country", "stg_pos_countries", f"""
    SELECT country_sk, country_id, country_name, iso_currency, iso_country, region_name, true AS is_active
    FROM (SELECT country_id, any_value(country_sk) AS country_sk, any_value(country_name) AS country_name,
            any_value(iso_currency) AS iso_currency, any_value(iso_country) AS iso_country,
            any_value(region_name) AS region_name
        FROM stg_pos_countries GROUP BY country_id)""")
cte("dim_city", "stg_pos_countries", f"""
    SELECT DISTINCT {key("c.city_id")} AS city_sk, c.city_id, c.city_name,
        {key("c.country_id")} AS country_sk, c.population,
        {case_in("co.iso_country", rules.TIME_ZONES, "'UTC'")} AS timezone, true AS is_active
    FROM stg_pos_countries c LEFT JOIN stg_pos_countries co ON c.country_id = co.country_id""")
cte("dim_location", "stg_pos_locations", f"""
    SELECT {key("location_id")} AS location_sk, *, NULL AS latitude, NULL AS longitude,
        {case_rules(rules.BUSINESS_POTENTIAL, 60, type="location_type", traffic="estimated_foot_traffic")}
            AS business_potential_score, true AS is_active
    FROM stg_pos_locations""")
cte("dim_franchise", "stg_pos_franchises", f"""
    SELECT {key("franchise_id")} AS franchise_sk, *,
        CASE WHEN has_complete_name AND has_valid_email THEN 'Complete Profile'
            WHEN has_complete_name THEN 'Basic Profile' ELSE 'Incomplete Profile' END
            AS profile_completeness, true AS is_active
    FROM stg_pos_franchises""")
cte("dim_truck", "stg_pos_trucks dim_franchise", f"""
    SELECT {key("truck_id")} AS truck_sk, t.*, f.franchise_sk,
        CASE WHEN is_electric_vehicle THEN 100 ELSE
            {case_band(f"year({AS_OF}) - vehicle_year", "<=", rules.SUSTAINABILITY_MAX, 40)} END
            AS sustainability_score,
        {case_rules(rules.OPERATIONAL_CATEGORIES, "Inactive", days="days_in_operation",
                    status="operational_status")} AS operational_category,
        operational_status AS truck_status, true AS is_active
    FROM stg_pos_trucks t LEFT JOIN dim_franchise f ON t.franchise_id = f.franchise_id AND t.is_franchise""")
cte("dim_customer", "int_customers_segmented", f"""
    SELECT {key("customer_id")} AS customer_sk, *,
        {case_band("estimated_lifetime_value", ">=", rules.VALUE_TIER_MIN, "Minimal Value")}
            AS customer_value_tier,
        {case_in("digital_engagement_level", rules.CONTACT_PREFERENCES, "'Traditional Preferred'")}
            AS communication_preference, true AS is_active
    FROM int_customers_segmented""")
cte("dim_menu_item", "int_menu_profitability", f"""
    SELECT {key("menu_item_id")} AS menu_item_sk, *,
        {case_rules(rules.MENU_MATRIX, "Question Mark", margin="profit_margin_pct",
                    tier="sales_performance_tier")} AS menu_matrix_classification,
        CAST(is_vegetarian AS INT) + CAST(is_vegan AS INT) + CAST(is_gluten_free AS INT)
            AS dietary_options_score, true AS is_active
    FROM int_menu_profitability""")

# -------------------------------------------------------------------------------------------- facts
cte("fact_order", "int_orders_enriched dim_truck dim_location dim_customer dim_date dim_time", f"""
    SELECT {key("order_id")} AS order_sk, o.* EXCLUDE (discount_id),
        coalesce(truck_sk, '{rules.UNKNOWN_KEY}') AS truck_sk,
        coalesce(location_sk, '{rules.UNKNOWN_KEY}') AS location_sk,
        coalesce(customer_sk, '{rules.UNKNOWN_KEY}') AS customer_sk,
        coalesce(date_sk, {rules.UNKNOWN_NUMBER}) AS order_date_sk,
        coalesce(time_sk, {rules.UNKNOWN_NUMBER}) AS order_time_sk
    FROM int_orders_enriched o
        LEFT JOIN dim_truck t ON o.truck_id = t.truck_id
        LEFT JOIN dim_location l ON o.location_id = l.location_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_date d ON CAST(o.order_timestamp AS DATE) = d.date_actual
        LEFT JOIN dim_time m ON CAST(o.order_timestamp AS TIME) = CAST(m.time_actual AS TIME)""")
_line_cost = "(quantity * coalesce(cost_of_goods_usd, 0))"
cte("fact_order_detail", "stg_pos_order_details fact_order dim_menu_item", f"""
    SELECT {key("order_detail_id")} AS order_detail_sk, d.*,
        coalesce(order_sk, '{rules.UNKNOWN_KEY}') AS order_sk,
        coalesce(menu_item_sk, '{rules.UNKNOWN_KEY}') AS menu_item_sk, {_line_cost} AS line_cost_of_goods,
        net_line_total - {_line_cost} AS line_profit,
        {pct(f"(net_line_total - {_line_cost})", "net_line_total")} AS line_profit_margin_pct,
        item_category, item_subcategory, truck_brand_name, is_vegetarian, is_vegan, is_gluten_free
    FROM stg_pos_order_details d LEFT JOIN fact_order o ON d.order_id = o.order_id
        LEFT JOIN dim_menu_item m ON d.menu_item_id = m.menu_item_id
    WHERE is_valid_line_item""")

# -------------------------------------------------------------------------------------------- marts


def orders_where(condition: str, name: str) -> str:
    return f"count(DISTINCT order_id) FILTER ({condition}) AS {name}"


cte("daily_base", "fact_order dim_date dim_truck dim_location", f"""
    SELECT date_actual AS sales_date, o.truck_sk, o.location_sk, t.country_name,
        primary_city AS city_name, truck_status, is_electric_vehicle, location_type,
        estimated_foot_traffic, count(DISTINCT order_id) AS total_orders, sum(order_total) AS total_revenue,
        sum(total_cost_of_goods) AS total_cost_of_goods, sum(order_profit) AS total_profit,
        {average("order_total")} AS avg_order_value, count(DISTINCT customer_sk) AS unique_customers,
        avg(processing_time_minutes) AS avg_processing_time_minutes,
        sum(line_item_count) AS total_line_items, sum(total_items_ordered) AS total_items_sold,
        avg(line_item_count) AS avg_items_per_order,
        {orders_where("order_channel = 'Mobile App'", "mobile_orders")},
        {orders_where("order_channel = 'Walk-up'", "walkin_orders")},
        {orders_where("meal_period = 'Breakfast'", "breakfast_orders")},
        {orders_where("meal_period = 'Lunch'", "lunch_orders")},
        {orders_where("meal_period = 'Dinner'", "dinner_orders")},
        {orders_where("discount_percentage > 0", "discounted_orders")}
    FROM fact_order o JOIN dim_date d ON o.order_date_sk = d.date_sk
        JOIN dim_truck t ON o.truck_sk = t.truck_sk LEFT JOIN dim_location l ON o.location_sk = l.location_sk
    GROUP BY ALL""")
_series = "PARTITION BY truck_sk, location_sk ORDER BY sales_date"
_per_day = "PARTITION BY sales_date ORDER BY {0} DESC NULLS FIRST, truck_sk, location_sk"


def growth(column: str, before: str) -> str:
    return pct(f"({column} - {before})", before)


cte("daily_windows", "daily_base", f"""
    SELECT *, {pct("total_profit", "total_revenue")} AS profit_margin_pct,
        row_number() OVER ({_per_day.format("total_revenue")}) AS daily_revenue_rank,
        row_number() OVER ({_per_day.format("total_orders")}) AS daily_order_rank,
        row_number() OVER ({_per_day.format("total_profit")}) AS daily_profit_rank,
        avg(total_revenue) OVER ({_series} ROWS 6 PRECEDING) AS revenue_7day_avg,
        avg(total_orders) OVER ({_series} ROWS 6 PRECEDING) AS orders_7day_avg,
        lag(total_revenue, 7) OVER ({_series}) AS revenue_prev_week,
        lag(total_orders, 7) OVER ({_series}) AS orders_prev_week
    FROM daily_base""")
cte("agg_daily_sales", "daily_windows", f"""
    SELECT *, {growth("total_revenue", "revenue_prev_week")} AS revenue_wow_growth_pct,
        {growth("total_orders", "orders_prev_week")} AS orders_wow_growth_pct FROM daily_windows""")

_meals = {f"{m.lower()}_orders": hours for hours, m in rules.MEAL_HOURS}
cte("location_days", "fact_order dim_date dim_location", f"""
    SELECT o.location_sk, date_actual AS analysis_date, location_name, city_name, country_name,
        location_type, estimated_foot_traffic, business_potential_score, day_of_week_name, is_weekend,
        {case_in("month_number", rules.SEASONS, "'Fall'")} AS season,
        count(DISTINCT order_id) AS daily_orders, sum(order_total) AS daily_revenue,
        count(DISTINCT truck_sk) AS trucks_served, count(DISTINCT customer_sk) AS unique_customers,
        {average("order_total")} AS avg_order_value, avg(processing_time_minutes) AS avg_processing_time,
        {", ".join(orders_where(f"order_hour BETWEEN {a} AND {b}", n) for n, (a, b) in _meals.items())}
    FROM fact_order o JOIN dim_date d ON o.order_date_sk = d.date_sk
        LEFT JOIN dim_location l ON o.location_sk = l.location_sk
    WHERE o.location_sk <> '{rules.UNKNOWN_KEY}' GROUP BY ALL""")
_loc_month = "PARTITION BY location_sk, date_trunc('month', analysis_date)"
_loc_day = "PARTITION BY analysis_date ORDER BY {0} DESC NULLS FIRST, location_sk"
_loc_series = "PARTITION BY location_sk ORDER BY analysis_date ROWS 6 PRECEDING"
cte("location_windows", "location_days", f"""
    SELECT *, CAST(daily_revenue AS DOUBLE) / trucks_served AS revenue_per_truck,
        CAST(daily_orders AS DOUBLE) / trucks_served AS orders_per_truck,
        {peak([(rules.PEAK_WINDOWS[m][0], m) for m in _meals])} AS peak_hour_start,
        {peak([(rules.PEAK_WINDOWS[m][1], m) for m in _meals])} AS peak_hour_end,
        first_value(day_of_week_name) OVER ({_loc_month} ORDER BY daily_revenue DESC, analysis_date)
            AS busiest_day_of_week,
        avg(CASE WHEN is_weekend THEN daily_revenue END) OVER ({_loc_month}) AS avg_weekend_revenue,
        avg(CASE WHEN NOT is_weekend THEN daily_revenue END) OVER ({_loc_month}) AS avg_weekday_revenue,
        row_number() OVER ({_loc_day.format("daily_revenue")}) AS daily_revenue_rank,
        row_number() OVER ({_loc_day.format("CAST(daily_revenue AS DOUBLE) / trucks_served")})
            AS efficiency_rank,
        avg(daily_revenue) OVER ({_loc_series}) AS revenue_7day_avg,
        avg(daily_orders) OVER ({_loc_series}) AS orders_7day_avg,
        avg(daily_revenue) OVER (PARTITION BY location_sk, season) AS seasonal_avg_revenue
    FROM location_days""")
_potential = case(
    [(f"revenue_7day_avg >= seasonal_avg_revenue * {r}", str(s)) for r, s in rules.POTENTIAL_RATIO_MIN], "50"
)
cte("agg_location_insights", "location_windows", f"""
    SELECT *, CASE WHEN avg_weekday_revenue > 0 THEN avg_weekend_revenue / avg_weekday_revenue ELSE 0 END
            AS weekend_vs_weekday_ratio,
        {pct("daily_revenue", "business_potential_score")} AS foot_traffic_score,
        {_potential} AS revenue_potential_score,
        {case_band("daily_revenue_rank", "<=", rules.LOCATION_RANK_MAX, "Underperforming")}
            AS location_performance_category
    FROM location_windows""")

_item_day = "PARTITION BY analysis_date ORDER BY {0} DESC NULLS FIRST, menu_item_sk"


def sold_where(condition: str, name: str) -> str:
    return f"coalesce(sum(quantity) FILTER ({condition}), 0) AS {name}"


cte("menu_days", "fact_order_detail fact_order dim_date dim_menu_item dim_truck", f"""
    SELECT date_actual AS analysis_date, l.menu_item_sk, menu_item_name, m.truck_brand_name,
        m.item_category, m.item_subcategory, sale_price_usd, cost_of_goods_usd, m.is_vegetarian,
        m.is_vegan, m.is_gluten_free, menu_matrix_classification, sum(quantity) AS total_quantity_sold,
        count(DISTINCT l.order_sk) AS orders_containing_item, sum(line_total) AS total_revenue,
        sum(line_cost_of_goods) AS total_cost_of_goods, sum(line_profit) AS total_profit,
        {average("unit_price")} AS avg_selling_price, sum(line_discount_amount) AS total_discounts_given,
        count(DISTINCT t.truck_id) AS trucks_selling_item,
        count(DISTINCT o.customer_sk) AS unique_customers,
        {sold_where("order_channel = 'Mobile App'", "mobile_quantity")},
        {sold_where("order_channel = 'Walk-up'", "walkin_quantity")},
        {sold_where("meal_period = 'Breakfast'", "breakfast_quantity")},
        {sold_where("meal_period = 'Lunch'", "lunch_quantity")},
        {sold_where("meal_period = 'Dinner'", "dinner_quantity")}
    FROM fact_order_detail l JOIN fact_order o ON l.order_sk = o.order_sk
        JOIN dim_date d ON o.order_date_sk = d.date_sk JOIN dim_menu_item m ON l.menu_item_sk = m.menu_item_sk
        JOIN dim_truck t ON o.truck_sk = t.truck_sk
    WHERE l.menu_item_sk <> '{rules.UNKNOWN_KEY}' GROUP BY ALL""")
cte("menu_margins", "menu_days", f"SELECT *, {pct('total_profit', 'total_revenue', places=8)} AS profit_margin_pct FROM menu_days")
cte("agg_menu_performance", "menu_margins", f"""
    SELECT *, row_number() OVER ({_item_day.format("total_quantity_sold")}) AS popularity_rank,
        row_number() OVER ({_item_day.format("total_revenue")}) AS revenue_rank,
        row_number() OVER ({_item_day.format("total_profit")}) AS profit_rank,
        row_number() OVER (PARTITION BY analysis_date, item_category
            ORDER BY total_quantity_sold DESC, menu_item_sk) AS category_popularity_rank,
        {peak([(m, f"{m.lower()}_quantity") for m in ("Breakfast", "Lunch", "Dinner")])} AS peak_meal_period,
        CASE sign(mobile_quantity - walkin_quantity) WHEN 1 THEN 'Mobile Preferred'
            WHEN -1 THEN 'Walk-up Preferred' ELSE 'Balanced' END AS channel_preference,
        {case_rules(rules.ITEM_CLASSES, "Standard", sold="total_quantity_sold", margin="profit_margin_pct")}
            AS performance_classification
    FROM menu_margins""")


def first_mode(values: str, name: str, by: str, source: str) -> str:
    """Most frequent value per group, the smallest among equals."""
    return (
        f"SELECT {by}, {values} AS {name} FROM {source} WHERE {values} IS NOT NULL GROUP BY {by}, {values} "
        f"QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {values}) = 1"
    )


cte("customer_rows", "fact_order dim_date dim_truck dim_location", f"""
    SELECT o.*, date_actual, primary_city, location_type
    FROM fact_order o JOIN dim_date d ON o.order_date_sk = d.date_sk
        LEFT JOIN dim_truck t ON o.truck_sk = t.truck_sk
        LEFT JOIN dim_location l ON o.location_sk = l.location_sk
    WHERE o.customer_sk <> '{rules.UNKNOWN_KEY}'""")
cte("customer_totals", "customer_rows", f"""
    SELECT customer_sk, count(DISTINCT order_id) AS total_orders, sum(order_total) AS total_spent,
        {average("order_total")} AS avg_order_value, min(date_actual) AS first_order_date,
        max(date_actual) AS last_order_date, {_gap.format("date_actual")} AS avg_days_between_orders,
        date_diff('day', max(date_actual), {AS_OF}) AS days_since_last_order,
        {orders_where(_in_90.format("date_actual"), "orders_last_90_days")},
        sum(order_total) FILTER ({_in_90.format("date_actual")}) AS spent_last_90_days,
        {orders_where("order_channel = 'Mobile App'", "mobile_orders")},
        {orders_where("order_channel = 'Walk-up'", "walkin_orders")},
        {orders_where("order_channel = 'Online'", "online_orders")},
        {orders_where("meal_period = 'Breakfast'", "breakfast_orders")},
        {orders_where("meal_period = 'Lunch'", "lunch_orders")},
        {orders_where("meal_period = 'Dinner'", "dinner_orders")},
        count(DISTINCT location_sk) AS unique_locations_visited,
        count(DISTINCT truck_sk) AS unique_trucks_visited,
        {orders_where("discount_percentage > 0", "discounted_orders")},
        avg(discount_percentage) AS avg_discount_percentage, avg(line_item_count) AS avg_items_per_order,
        avg(processing_time_minutes) AS avg_processing_time
    FROM customer_rows GROUP BY customer_sk""")
cte("customer_lines", "fact_order fact_order_detail dim_menu_item", f"""
    SELECT customer_sk, m.item_category, m.item_subcategory, m.truck_brand_name, m.is_vegetarian,
        m.is_vegan, m.is_gluten_free, quantity, unit_price
    FROM fact_order o JOIN fact_order_detail l ON o.order_sk = l.order_sk
        JOIN dim_menu_item m ON l.menu_item_sk = m.menu_item_sk
    WHERE customer_sk <> '{rules.UNKNOWN_KEY}'""")
for _column, _name, _source in (
    ("primary_city", "preferred_city", "customer_rows"),
    ("location_type", "preferred_location_type", "customer_rows"),
    ("item_category", "favorite_category", "customer_lines"),
    ("item_subcategory", "favorite_subcategory", "customer_lines"),
    ("truck_brand_name", "favorite_brand", "customer_lines"),
):
    cte(f"{_name}_of", _source, first_mode(_column, _name, "customer_sk", _source))
cte("customer_tastes", "customer_lines favorite_category_of favorite_subcategory_of favorite_brand_of", f"""
    SELECT customer_sk, any_value(favorite_category) AS favorite_category,
        any_value(favorite_subcategory) AS favorite_subcategory, any_value(favorite_brand) AS favorite_brand,
        {sold_where("is_vegetarian", "vegetarian_items_ordered")},
        {sold_where("is_vegan", "vegan_items_ordered")},
        {sold_where("is_gluten_free", "gluten_free_items_ordered")},
        sum(quantity) AS total_items_ordered, {average("unit_price")} AS avg_item_price_preference,
        quantile_cont(CAST(unit_price AS DOUBLE), 0.5) AS median_item_price_preference
    FROM customer_lines LEFT JOIN favorite_category_of USING (customer_sk)
        LEFT JOIN favorite_subcategory_of USING (customer_sk) LEFT JOIN favorite_brand_of USING (customer_sk)
    GROUP BY customer_sk""")
_three = {k: f"coalesce(h.{k}_orders, 0)" for k in ("mobile", "walkin", "online")}
_dominant = case(
    [(f"2 * {_three[k]} > {' + '.join(_three.values())}", text(f"{label} Dominant"))
     for k, label in (("mobile", "Mobile"), ("walkin", "Walk-up"), ("online", "Online"))],
    "'Multi-Channel'",
)
_zeroed = [
    "total_orders", "total_spent", "avg_order_value", "orders_last_90_days", "spent_last_90_days",
    "mobile_orders", "walkin_orders", "breakfast_orders", "lunch_orders", "dinner_orders",
    "unique_locations_visited", "unique_trucks_visited", "discounted_orders",
    "avg_discount_percentage", "avg_items_per_order", "avg_processing_time",
]
cte("agg_customer_360", "dim_customer customer_totals customer_tastes preferred_city_of preferred_location_type_of", f"""
    SELECT c.customer_sk, c.customer_id, c.customer_name, c.city_name, c.country_name, c.age_group,
        c.gender, c.marital_status, c.sign_up_date, c.customer_segment, c.digital_engagement_level,
        c.price_sensitivity, c.customer_value_tier, h.first_order_date, h.last_order_date,
        {", ".join(f"coalesce(h.{n}, 0) AS {n}" for n in _zeroed)},
        coalesce(h.days_since_last_order, {rules.NEVER_ORDERED_DAYS}) AS days_since_last_order,
        h.avg_days_between_orders, t.favorite_category, t.favorite_subcategory, t.favorite_brand,
        pc.preferred_city, pl.preferred_location_type,
        {pct("t.vegetarian_items_ordered", "t.total_items_ordered")} AS vegetarian_preference_pct,
        {pct("t.vegan_items_ordered", "t.total_items_ordered")} AS vegan_preference_pct,
        {lifetime("h.total_orders", "h.total_spent", "h.avg_order_value", "h.avg_days_between_orders",
                  "c.estimated_lifetime_value")} AS calculated_lifetime_value,
        CASE WHEN h.days_since_last_order IS NULL THEN 1.0 ELSE
            {case_band("h.days_since_last_order", "<=", rules.CHURN_RISK_MAX, 0.95)} END AS churn_risk_score,
        coalesce(h.orders_last_90_days, 0) > 0 AS is_active_customer,
        {case_rules(rules.JOURNEY, "At Risk", orders="h.total_orders", recency="h.days_since_last_order",
                    gap="h.avg_days_between_orders")} AS customer_journey_stage,
        {_dominant} AS channel_preference,
        {peak([(m, f"coalesce(h.{m.lower()}_orders, 0)") for m in ("Breakfast", "Lunch", "Dinner")])}
            AS preferred_meal_period
    FROM dim_customer c LEFT JOIN customer_totals h ON c.customer_sk = h.customer_sk
        LEFT JOIN customer_tastes t ON c.customer_sk = t.customer_sk
        LEFT JOIN preferred_city_of pc ON c.customer_sk = pc.customer_sk
        LEFT JOIN preferred_location_type_of pl ON c.customer_sk = pl.customer_sk""")

# -------------------------------------------------------------------------- what the models deliver
SPECS: dict[str, str] = {
    "dim_date": "date_sk:i date_actual:D day_of_month:i day_of_year:i day_of_week:i day_of_week_name:s "
        "week_of_year:i month_number:i month_name:s month_short_name:s quarter_number:i quarter_name:s "
        "year_number:i is_weekend:b is_weekday:b fiscal_year:i fiscal_quarter:i fiscal_month:i "
        "is_holiday:b holiday_name:s",
    "dim_time": "time_sk:i time_actual:s hour_24:i hour_12:i am_pm:s minute_number:i hour_minute:s "
        "day_part:s meal_period:s",
    "stg_pos_countries": "country_sk:s country_id:l city_id:l city_name:s population:s country_name:s "
        "iso_currency:s iso_country:s region_name:s is_valid_record:b",
    "stg_pos_franchises": "franchise_id:l franchise_owner_name:s first_name:s last_name:s city_name:s "
        "country_name:s email:s phone_number:s has_complete_name:b has_valid_email:b",
    "stg_pos_locations": "location_id:l placekey:s location_name:s city_name:s region_name:s "
        "iso_country_code:s country_name:s location_type:s estimated_foot_traffic:s",
    "stg_pos_menu": "menu_id:l menu_type_id:l menu_type_name:s truck_brand_name:s menu_item_id:l "
        "menu_item_name:s item_category:s item_subcategory:s cost_of_goods_usd:m sale_price_usd:m "
        "profit_margin_pct:m calories:l protein_grams:l carbs_grams:l fat_grams:l sodium_mg:l "
        "is_vegetarian:b is_vegan:b is_gluten_free:b has_valid_pricing:b",
    "stg_pos_trucks": "truck_id:l menu_type_id:l franchise_id:l primary_city:s region_name:s iso_region:s "
        "country_name:s iso_country_code:s is_franchise:b vehicle_year:i vehicle_make:s vehicle_model:s "
        "is_electric_vehicle:b truck_opening_date:D vehicle_age_category:s operational_status:s "
        "days_in_operation:i truck_maturity:s",
    "stg_customer_loyalty": "customer_id:l first_name:s last_name:s customer_name:s city_name:s "
        "country_name:s postal_code:s preferred_language:s gender:s favourite_brand:s marital_status:s "
        "children_count:l sign_up_date:D birthday_date:D email:s phone_number:s age:i age_group:s "
        "days_since_signup:i initial_segment:s has_complete_name:b has_valid_email:b has_valid_birthday:b",
    "stg_pos_order_headers": "order_id:l truck_id:l location_id:d customer_id:l discount_id:s shift_id:l "
        "shift_start_time:s shift_end_time:s order_channel:s order_timestamp:t served_timestamp:t "
        "order_currency:s order_amount:m order_tax_amount:m order_discount_amount:m order_total:m "
        "processing_time_minutes:i discount_percentage:m order_hour:i order_day_of_week:i meal_period:s",
    "stg_pos_order_details": "order_detail_id:l order_id:l menu_item_id:l discount_id:s line_number:i "
        "quantity:i unit_price:m line_total:m line_discount_amount:m calculated_unit_price:m "
        "line_discount_percentage:m net_line_total:m is_valid_line_item:b price_quantity_consistent:b",
    "dim_country": "country_sk:s country_id:l country_name:s iso_currency:s iso_country:s region_name:s "
        "is_active:b",
    "dim_city": "city_sk:s city_id:l city_name:s country_sk:s population:s timezone:s is_active:b",
    "dim_location": "location_sk:s location_id:l placekey:s location_name:s city_name:s region_name:s "
        "country_name:s iso_country_code:s location_type:s estimated_foot_traffic:s latitude:d longitude:d "
        "business_potential_score:i is_active:b",
    "dim_franchise": "franchise_sk:s franchise_id:l franchise_owner_name:s first_name:s last_name:s "
        "city_name:s country_name:s email:s phone_number:s has_complete_name:b has_valid_email:b "
        "profile_completeness:s is_active:b",
    "dim_truck": "truck_sk:s truck_id:l menu_type_id:l franchise_sk:s primary_city:s region_name:s "
        "country_name:s iso_country_code:s is_franchise:b vehicle_year:i vehicle_make:s vehicle_model:s "
        "is_electric_vehicle:b truck_opening_date:D vehicle_age_category:s operational_status:s "
        "days_in_operation:i truck_maturity:s sustainability_score:i operational_category:s "
        "truck_status:s is_active:b",
    "dim_customer": "customer_sk:s customer_id:l customer_name:s first_name:s last_name:s city_name:s "
        "country_name:s postal_code:s preferred_language:s gender:s favourite_brand:s marital_status:s "
        "children_count:l sign_up_date:D birthday_date:D email:s phone_number:s age:i age_group:s "
        "days_since_signup:i customer_segment:s digital_engagement_level:s price_sensitivity:s "
        "estimated_lifetime_value:m is_active_customer:b customer_value_tier:s communication_preference:s "
        "has_complete_name:b has_valid_email:b has_valid_birthday:b is_active:b",
    "dim_menu_item": "menu_item_sk:s menu_item_id:l menu_id:l menu_type_id:l menu_type_name:s "
        "truck_brand_name:s menu_item_name:s item_category:s item_subcategory:s cost_of_goods_usd:m "
        "sale_price_usd:m profit_margin_pct:m calories:l protein_grams:l carbs_grams:l fat_grams:l "
        "sodium_mg:l is_vegetarian:b is_vegan:b is_gluten_free:b has_valid_pricing:b "
        "sales_performance_tier:s profitability_tier:s trend_status:s peak_meal_period:s "
        "menu_matrix_classification:s dietary_options_score:i is_active:b",
    "fact_order": "order_sk:s order_id:l truck_sk:s location_sk:s customer_sk:s order_date_sk:i "
        "order_time_sk:i shift_id:l shift_start_time:s shift_end_time:s order_channel:s order_timestamp:t "
        "served_timestamp:t order_currency:s meal_period:s order_hour:i order_day_of_week:i order_amount:m "
        "order_tax_amount:m order_discount_amount:m order_total:m total_cost_of_goods:m order_profit:m "
        "order_profit_margin_pct:m processing_time_minutes:i line_item_count:l total_items_ordered:l "
        "avg_item_price:m order_size_category:s service_speed_category:s revenue_category:s "
        "discount_percentage:m category_count:l categories_ordered:s",
    "fact_order_detail": "order_detail_sk:s order_detail_id:l order_sk:s menu_item_sk:s discount_id:s "
        "line_number:i quantity:i unit_price:m line_total:m line_discount_amount:m net_line_total:m "
        "line_discount_percentage:m line_cost_of_goods:m line_profit:m line_profit_margin_pct:m "
        "item_category:s item_subcategory:s truck_brand_name:s is_vegetarian:b is_vegan:b "
        "is_gluten_free:b is_valid_line_item:b price_quantity_consistent:b",
    "agg_daily_sales": "sales_date:D truck_sk:s location_sk:s country_name:s city_name:s truck_status:s "
        "is_electric_vehicle:b location_type:s estimated_foot_traffic:s total_orders:l total_revenue:m "
        "total_cost_of_goods:m total_profit:m avg_order_value:m unique_customers:l "
        "avg_processing_time_minutes:m total_line_items:l total_items_sold:l avg_items_per_order:m "
        "mobile_orders:l walkin_orders:l breakfast_orders:l lunch_orders:l dinner_orders:l "
        "discounted_orders:l profit_margin_pct:m daily_revenue_rank:i daily_order_rank:i "
        "daily_profit_rank:i revenue_7day_avg:m orders_7day_avg:m revenue_prev_week:m "
        "orders_prev_week:l revenue_wow_growth_pct:m orders_wow_growth_pct:m",
    "agg_location_insights": "location_sk:s analysis_date:D location_name:s city_name:s country_name:s "
        "location_type:s estimated_foot_traffic:s business_potential_score:i daily_orders:l "
        "daily_revenue:m trucks_served:l unique_customers:l avg_order_value:m revenue_per_truck:m "
        "orders_per_truck:m peak_hour_start:s peak_hour_end:s busiest_day_of_week:s "
        "avg_weekend_revenue:m avg_weekday_revenue:m daily_revenue_rank:i efficiency_rank:i "
        "revenue_7day_avg:m orders_7day_avg:m seasonal_avg_revenue:m weekend_vs_weekday_ratio:m "
        "foot_traffic_score:m revenue_potential_score:i location_performance_category:s",
    "agg_menu_performance": "analysis_date:D menu_item_sk:s menu_item_name:s truck_brand_name:s "
        "item_category:s item_subcategory:s sale_price_usd:m cost_of_goods_usd:m is_vegetarian:b "
        "is_vegan:b is_gluten_free:b menu_matrix_classification:s total_quantity_sold:l "
        "orders_containing_item:l total_revenue:m total_cost_of_goods:m total_profit:m "
        "avg_selling_price:m total_discounts_given:m trucks_selling_item:l unique_customers:l "
        "mobile_quantity:l walkin_quantity:l breakfast_quantity:l lunch_quantity:l dinner_quantity:l "
        "profit_margin_pct:m popularity_rank:i revenue_rank:i profit_rank:i category_popularity_rank:i "
        "peak_meal_period:s channel_preference:s performance_classification:s",
    "agg_customer_360": "customer_sk:s customer_id:l customer_name:s city_name:s country_name:s "
        "age_group:s gender:s marital_status:s sign_up_date:D customer_segment:s "
        "digital_engagement_level:s price_sensitivity:s customer_value_tier:s total_orders:l "
        "total_spent:m avg_order_value:m first_order_date:D last_order_date:D days_since_last_order:i "
        "avg_days_between_orders:m orders_last_90_days:l spent_last_90_days:m mobile_orders:l "
        "walkin_orders:l breakfast_orders:l lunch_orders:l dinner_orders:l favorite_category:s "
        "favorite_subcategory:s favorite_brand:s preferred_city:s preferred_location_type:s "
        "unique_locations_visited:l unique_trucks_visited:l discounted_orders:l "
        "avg_discount_percentage:m avg_items_per_order:m avg_processing_time:m "
        "vegetarian_preference_pct:m vegan_preference_pct:m calculated_lifetime_value:m "
        "churn_risk_score:m is_active_customer:b customer_journey_stage:s channel_preference:s "
        "preferred_meal_period:s",
}
SPECS["int_orders_enriched"] = SPECS["stg_pos_order_headers"] + (
    " line_item_count:l total_items_ordered:l calculated_order_total:m avg_item_price:m "
    "total_line_discounts:m category_count:l categories_ordered:s total_cost_of_goods:m order_profit:m "
    "order_profit_margin_pct:m order_size_category:s service_speed_category:s revenue_category:s"
)
SPECS["int_menu_profitability"] = SPECS["stg_pos_menu"] + (
    " orders_containing_item:l total_quantity_sold:l total_revenue:m avg_selling_price:m "
    "total_discounts_given:m quantity_sold_30_days:l revenue_30_days:m total_profit:m "
    "actual_profit_margin_pct:m sales_performance_tier:s profitability_tier:s trend_status:s "
    "mobile_sales:l walkin_sales:l breakfast_sales:l lunch_sales:l dinner_sales:l peak_meal_period:s"
)
SPECS["int_customers_segmented"] = SPECS["stg_customer_loyalty"] + (
    " total_orders:l total_spent:m avg_order_value:m first_order_date:D last_order_date:D "
    "avg_days_between_orders:m days_since_last_order:i mobile_orders:l lunch_orders:l "
    "discounted_orders:l orders_last_90_days:l spent_last_90_days:m estimated_lifetime_value:m "
    "customer_segment:s digital_engagement_level:s price_sensitivity:s is_active_customer:b"
)


def model_sql() -> dict[str, str]:
    return {name: model(name, spec) for name, spec in SPECS.items()}
