"""Silver, first step: cleaned copies of the raw tables, one row in, at most one row out.

Only projections and filters, so none of these needs a shuffle and the not-null filters reach the
scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.functions.text import is_email
from layercake.plans.run import Run

c = F.col


def stg_pos_countries(country: DataFrame, run: Run) -> DataFrame:
    """Cities with their country; rows without country name or ISO code are left out."""
    name, iso = c("country"), c("iso_country")
    named = F.trim(name) != ""
    cleaned = country.where(c("country_id").isNotNull() & named & iso.isNotNull()).select(
        fn.surrogate_key(c("country_id")).alias("country_sk"),
        "country_id",
        "city_id",
        c("city").alias("city_name"),
        c("city_population").alias("population"),
        fn.normalize(fn.code(name), rules.COUNTRY_NAMES, fn.clean_name(name)).alias("country_name"),
        F.when(F.length(F.trim("iso_currency")) == 3, fn.code(c("iso_currency")))
        .otherwise(rules.DEFAULT_CURRENCY)
        .alias("iso_currency"),
        F.when(F.length(F.trim(iso)) == 2, fn.code(iso)).alias("iso_country"),
        fn.normalize(iso, rules.REGIONS, "Other").alias("region_name"),
        F.lit(True).alias("is_valid_record"),
    )
    return run.audited(cleaned)


def stg_pos_franchises(franchise: DataFrame, run: Run) -> DataFrame:
    first, last, mail = c("first_name"), c("last_name"), c("e_mail")
    cleaned = franchise.where(c("franchise_id").isNotNull()).select(
        "franchise_id",
        fn.full_name(first, last).alias("franchise_owner_name"),
        "first_name",
        "last_name",
        fn.clean_name(c("city")).alias("city_name"),
        fn.clean_name(c("country")).alias("country_name"),
        fn.clean_email(mail).alias("email"),
        fn.digits(c("phone_number")).alias("phone_number"),
        (first.isNotNull() & last.isNotNull()).alias("has_complete_name"),
        fn.flag(is_email(mail)).alias("has_valid_email"),
    )
    return run.audited(cleaned)


def stg_pos_locations(location: DataFrame, run: Run) -> DataFrame:
    place = F.upper("location")
    cleaned = location.where(c("location_id").isNotNull() & (F.trim("location") != "")).select(
        "location_id",
        F.trim("placekey").alias("placekey"),
        fn.clean_name(c("location")).alias("location_name"),
        fn.clean_name(c("city")).alias("city_name"),
        fn.clean_name(c("region")).alias("region_name"),
        fn.code(c("iso_country_code")).alias("iso_country_code"),
        fn.clean_name(c("country")).alias("country_name"),
        fn.keyword_class(place, rules.LOCATION_TYPES, "Other").alias("location_type"),
        fn.keyword_class(place, rules.FOOT_TRAFFIC, "Low").alias("estimated_foot_traffic"),
    )
    return run.audited(cleaned)


def stg_pos_menu(menu: DataFrame, run: Run) -> DataFrame:
    cost, price = c("cost_of_goods_usd"), c("sale_price_usd")
    health = fn.as_variant(menu, "menu_item_health_metrics_obj")
    item = F.upper("menu_item_name")
    nutrients = [
        fn.variant_field(health, f"$.{field}", "decimal(38,0)", run.on_bad).alias(column)
        for column, field in rules.NUTRIENTS.items()
    ]
    diets = [
        (fn.variant_flag(health, f"$.{field}") | fn.contains_any(item, words)).alias(column)
        for column, (field, words) in rules.DIETS.items()
    ]
    margin = fn.safe_pct(price - F.coalesce(cost, F.lit(0)), price, places=8)
    cleaned = menu.where(c("menu_item_id").isNotNull() & (F.trim("menu_item_name") != "")).select(
        "menu_id",
        "menu_type_id",
        fn.clean_name(c("menu_type")).alias("menu_type_name"),
        fn.clean_name(c("truck_brand_name")).alias("truck_brand_name"),
        "menu_item_id",
        fn.clean_name(c("menu_item_name")).alias("menu_item_name"),
        fn.normalize(fn.code(c("item_category")), rules.CATEGORIES, fn.clean_name(c("item_category")))
        .alias("item_category"),
        fn.clean_name(c("item_subcategory")).alias("item_subcategory"),
        F.coalesce(cost, F.lit(0).cast("decimal(18,4)")).alias("cost_of_goods_usd"),
        F.coalesce(price, F.lit(0).cast("decimal(18,4)")).alias("sale_price_usd"),
        margin.alias("profit_margin_pct"),
        health.alias("health_metrics"),
        *nutrients,
        *diets,
        fn.flag((price > 0) & (cost >= 0) & (price > cost)).alias("has_valid_pricing"),
    )
    return run.audited(cleaned)


def stg_pos_trucks(truck: DataFrame, run: Run) -> DataFrame:
    opening = c("truck_opening_date")
    days = F.datediff(run.today, opening)
    age = F.year(run.today) - c("year")
    opened = days >= 0
    cleaned = truck.where(c("truck_id").isNotNull()).select(
        "truck_id",
        "menu_type_id",
        "franchise_id",
        fn.clean_name(c("primary_city")).alias("primary_city"),
        fn.clean_name(c("region")).alias("region_name"),
        fn.code(c("iso_region")).alias("iso_region"),
        fn.clean_name(c("country")).alias("country_name"),
        fn.code(c("iso_country_code")).alias("iso_country_code"),
        fn.flag(c("franchise_flag") == 1).alias("is_franchise"),
        c("year").alias("vehicle_year"),
        fn.clean_name(c("make")).alias("vehicle_make"),
        fn.clean_name(c("model")).alias("vehicle_model"),
        fn.flag(c("ev_flag") == 1).alias("is_electric_vehicle"),
        "truck_opening_date",
        fn.band(age, "<=", rules.VEHICLE_AGE_MAX, "Legacy").alias("vehicle_age_category"),
        F.when(opened, "Active").when(~opened, "Planned").otherwise("Unknown").alias("operational_status"),
        F.when(opened, days).otherwise(0).alias("days_in_operation"),
        F.when(~opened, "Pre-Launch")
        .otherwise(fn.band(days, "<=", rules.TRUCK_MATURITY_MAX, "Mature"))
        .alias("truck_maturity"),
    )
    return run.audited(cleaned)


def stg_customer_loyalty(loyalty: DataFrame, run: Run) -> DataFrame:
    first, last, mail, born = c("first_name"), c("last_name"), c("e_mail"), c("birthday_date")
    age = fn.years_between(born, run.today)
    tenure = F.datediff(run.today, c("sign_up_date"))
    oldest = F.lit(rules.EARLIEST_BIRTHDAY).cast("date")
    language = c("preferred_language")
    generation = F.when(
        age.isNotNull(), fn.band(age, "<", rules.AGE_GROUP_BELOW, "Boomer+")
    ).otherwise("Unknown")
    cleaned = loyalty.where(c("customer_id").isNotNull()).select(
        "customer_id",
        fn.clean_name(first).alias("first_name"),
        fn.clean_name(last).alias("last_name"),
        fn.full_name(first, last).alias("customer_name"),
        fn.clean_name(c("city")).alias("city_name"),
        fn.clean_name(c("country")).alias("country_name"),
        fn.code(c("postal_code")).alias("postal_code"),
        fn.normalize(fn.code(language), rules.LANGUAGES, fn.clean_name(language))
        .alias("preferred_language"),
        fn.normalize(fn.code(c("gender")), rules.GENDERS, "Not specified").alias("gender"),
        fn.clean_name(c("favourite_brand")).alias("favourite_brand"),
        fn.normalize(fn.code(c("marital_status")), rules.MARITAL, "Not specified")
        .alias("marital_status"),
        F.coalesce(c("children_count").try_cast("decimal(38,0)").cast("long"), F.lit(0).cast("long"))
        .alias("children_count"),
        "sign_up_date",
        "birthday_date",
        fn.clean_email(mail).alias("email"),
        fn.digits(c("phone_number")).alias("phone_number"),
        age.alias("age"),
        generation.alias("age_group"),
        tenure.alias("days_since_signup"),
        fn.band(tenure, "<=", rules.TENURE_MAX, "Veteran").alias("initial_segment"),
        (first.isNotNull() & last.isNotNull()).alias("has_complete_name"),
        fn.flag(is_email(mail)).alias("has_valid_email"),
        fn.flag(born.between(oldest, run.today)).alias("has_valid_birthday"),
    )
    return run.audited(cleaned)


def stg_pos_order_headers(order_header: DataFrame, run: Run) -> DataFrame:
    ts, amount = c("order_ts"), c("order_amount")
    served_text = fn.non_blank(c("served_ts").cast("string"))
    served = fn.strict_cast(served_text, "timestamp_ntz", run.on_bad)
    tax = fn.strict_cast(c("order_tax_amount"), "decimal(10,4)", run.on_bad)
    discount = fn.strict_cast(c("order_discount_amount"), "decimal(10,4)", run.on_bad)
    zero = F.lit(0).cast("decimal(10,4)")
    had_discount = c("order_discount_amount").isNotNull()
    valid = (
        c("order_id").isNotNull() & c("truck_id").isNotNull() & (c("order_total") > 0) & ts.isNotNull()
    )
    cleaned = order_header.where(valid).select(
        "order_id",
        "truck_id",
        "location_id",
        "customer_id",
        fn.non_blank(c("discount_id")).alias("discount_id"),
        "shift_id",
        "shift_start_time",
        "shift_end_time",
        fn.normalize(fn.code(c("order_channel")), rules.CHANNELS, "Other").alias("order_channel"),
        ts.alias("order_timestamp"),
        served.alias("served_timestamp"),
        F.coalesce(fn.code(c("order_currency")), F.lit(rules.DEFAULT_CURRENCY)).alias("order_currency"),
        F.coalesce(amount, F.lit(0).cast("decimal(18,4)")).alias("order_amount"),
        F.when(c("order_tax_amount").isNotNull(), tax).otherwise(zero).alias("order_tax_amount"),
        F.when(had_discount, discount).otherwise(zero).alias("order_discount_amount"),
        "order_total",
        fn.minutes_between(ts, served).cast("int").alias("processing_time_minutes"),
        F.when(had_discount, fn.safe_pct(discount, amount)).otherwise(0.0).alias("discount_percentage"),
        F.hour(ts).alias("order_hour"),
        fn.dow0(ts).alias("order_day_of_week"),
        fn.between_band(F.hour(ts), rules.MEAL_HOURS, "Late Night").alias("meal_period"),
    )
    return run.audited(cleaned)


def stg_pos_order_details(order_detail: DataFrame, run: Run) -> DataFrame:
    quantity, unit, price = c("quantity"), c("unit_price"), c("price")
    given = c("order_item_discount_amount").try_cast("decimal(10,4)")
    discount = F.coalesce(given, F.lit(0).cast("decimal(10,4)"))
    zero = F.lit(0).cast("decimal(18,4)")
    valid = (
        c("order_detail_id").isNotNull()
        & c("order_id").isNotNull()
        & c("menu_item_id").isNotNull()
        & (quantity > 0)
    )
    off = F.abs(price - quantity * unit)
    cleaned = order_detail.where(valid).select(
        "order_detail_id",
        "order_id",
        "menu_item_id",
        fn.non_blank(c("discount_id")).alias("discount_id"),
        "line_number",
        fn.clamp(quantity, 1, rules.MAX_QUANTITY).alias("quantity"),
        F.coalesce(unit, zero).alias("unit_price"),
        F.coalesce(price, zero).alias("line_total"),
        discount.alias("line_discount_amount"),
        F.when((quantity > 0) & (price > 0), price.cast("double") / quantity)
        .otherwise(unit.cast("double"))
        .alias("calculated_unit_price"),
        fn.safe_pct(given, price).alias("line_discount_percentage"),
        (price - discount).alias("net_line_total"),
        fn.flag((quantity > 0) & (unit >= 0) & (price >= 0)).alias("is_valid_line_item"),
        fn.flag(off <= F.lit(rules.PRICE_TOLERANCE).cast("decimal(4,2)"))
        .alias("price_quantity_consistent"),
    )
    return run.audited(cleaned)
