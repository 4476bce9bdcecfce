"""Gold dimensions: one row per natural key, the latest one, with a surrogate key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.operators.dedupe import keep_latest
from layercake.operators.joins import left_join_where_left
from layercake.plans.intermediate import SALES
from layercake.plans.run import Run

c = F.col


def _latest(df: DataFrame, key: str, follow: tuple[str, ...] = ()) -> DataFrame:
    return keep_latest(df.where(c(key).isNotNull()), [key], [c("updated_ts").desc()], follow)


def key_table(staged: DataFrame, key: str, name: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Natural key and surrogate key of a dimension, for lookups that need nothing else of it.

    Built from the staged table, so that looking up a key does not wait for the dimension's
    other columns.
    """
    if carry:
        return _latest(staged, key).select(key, fn.surrogate_key(c(key)).alias(name), *carry)
    keys = staged.where(c(key).isNotNull()).select(key).distinct()
    return keys.withColumn(name, fn.surrogate_key(c(key)))


def dim_country(countries: DataFrame, run: Run) -> DataFrame:
    """The staged table has one row per city; one of them stands for the country."""
    current = _latest(countries, "country_id").select(
        fn.surrogate_key(c("country_id")).alias("country_sk"),
        "country_id",
        "country_name",
        "iso_currency",
        "iso_country",
        "region_name",
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_city(countries: DataFrame, run: Run) -> DataFrame:
    """Cities with the time zone of their country.

    The zone comes from the ISO code of the country's latest row, joined at country grain: joining
    cities to cities would square the rows of a country.
    """
    zones = _latest(countries, "country_id").select(
        c("country_id").alias("_country"),
        fn.normalize(c("iso_country"), rules.TIME_ZONES, "UTC").alias("timezone"),
    )
    cities = _latest(countries, "city_id")
    joined = cities.join(zones, c("country_id") == c("_country"), "left")
    current = joined.select(
        fn.surrogate_key(c("city_id")).alias("city_sk"),
        "city_id",
        "city_name",
        fn.surrogate_key(c("country_id")).alias("country_sk"),
        "population",
        F.coalesce("timezone", F.lit("UTC")).alias("timezone"),
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_location(locations: DataFrame, run: Run) -> DataFrame:
    score = fn.classify(
        rules.BUSINESS_POTENTIAL, 60, type=c("location_type"), traffic=c("estimated_foot_traffic")
    )
    current = _latest(locations, "location_id").select(
        fn.surrogate_key(c("location_id")).alias("location_sk"),
        "location_id",
        "placekey",
        "location_name",
        "city_name",
        "region_name",
        "country_name",
        "iso_country_code",
        "location_type",
        "estimated_foot_traffic",
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        score.alias("business_potential_score"),
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_franchise(franchises: DataFrame, run: Run) -> DataFrame:
    profile = (
        F.when(~c("has_complete_name"), "Incomplete Profile")
        .when(c("has_valid_email"), "Complete Profile")
        .otherwise("Basic Profile")
    )
    current = _latest(franchises, "franchise_id").select(
        fn.surrogate_key(c("franchise_id")).alias("franchise_sk"),
        "franchise_id",
        "franchise_owner_name",
        "first_name",
        "last_name",
        "city_name",
        "country_name",
        "email",
        "phone_number",
        "has_complete_name",
        "has_valid_email",
        profile.alias("profile_completeness"),
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_truck(trucks: DataFrame, franchises: DataFrame, run: Run) -> DataFrame:
    """Trucks; those run by a franchise carry its key, the company's own carry none."""
    owners = franchises.select("franchise_id", "franchise_sk")
    owned = left_join_where_left(_latest(trucks, "truck_id"), owners, "franchise_id", c("is_franchise"))
    age = F.year(run.today) - c("vehicle_year")
    current = owned.select(
        fn.surrogate_key(c("truck_id")).alias("truck_sk"),
        "truck_id",
        "menu_type_id",
        "franchise_sk",
        "primary_city",
        "region_name",
        "country_name",
        "iso_country_code",
        "is_franchise",
        "vehicle_year",
        "vehicle_make",
        "vehicle_model",
        "is_electric_vehicle",
        "truck_opening_date",
        "vehicle_age_category",
        "operational_status",
        "days_in_operation",
        "truck_maturity",
        F.when(c("is_electric_vehicle"), 100)
        .otherwise(fn.band(age, "<=", rules.SUSTAINABILITY_MAX, 40))
        .alias("sustainability_score"),
        fn.classify(
            rules.OPERATIONAL_CATEGORIES,
            "Inactive",
            days=c("days_in_operation"),
            status=c("operational_status"),
        ).alias("operational_category"),
        c("operational_status").alias("truck_status"),
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_customer(customers: DataFrame, run: Run) -> DataFrame:
    current = _latest(customers, "customer_id").select(
        fn.surrogate_key(c("customer_id")).alias("customer_sk"),
        "customer_id",
        "customer_name",
        "first_name",
        "last_name",
        "city_name",
        "country_name",
        "postal_code",
        "preferred_language",
        "gender",
        "favourite_brand",
        "marital_status",
        "children_count",
        "sign_up_date",
        "birthday_date",
        "email",
        "phone_number",
        "age",
        "age_group",
        "days_since_signup",
        "customer_segment",
        "digital_engagement_level",
        "price_sensitivity",
        "estimated_lifetime_value",
        "is_active_customer",
        fn.band(c("estimated_lifetime_value"), ">=", rules.VALUE_TIER_MIN, "Minimal Value")
        .alias("customer_value_tier"),
        fn.normalize(
            c("digital_engagement_level"), rules.CONTACT_PREFERENCES, "Traditional Preferred"
        ).alias("communication_preference"),
        "has_complete_name",
        "has_valid_email",
        "has_valid_birthday",
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)


def dim_menu_item(items: DataFrame, run: Run) -> DataFrame:
    matrix = fn.classify(
        rules.MENU_MATRIX,
        "Question Mark",
        margin=c("profit_margin_pct"),
        tier=c("sales_performance_tier"),
    )
    options = sum((c(diet).cast("int") for diet in rules.DIETS), F.lit(0))
    current = _latest(items, "menu_item_id", SALES).select(
        fn.surrogate_key(c("menu_item_id")).alias("menu_item_sk"),
        "menu_item_id",
        "menu_id",
        "menu_type_id",
        "menu_type_name",
        "truck_brand_name",
        "menu_item_name",
        "item_category",
        "item_subcategory",
        "cost_of_goods_usd",
        "sale_price_usd",
        "profit_margin_pct",
        "health_metrics",
        "calories",
        "protein_grams",
        "carbs_grams",
        "fat_grams",
        "sodium_mg",
        "is_vegetarian",
        "is_vegan",
        "is_gluten_free",
        "has_valid_pricing",
        "sales_performance_tier",
        "profitability_tier",
        "trend_status",
        "peak_meal_period",
        matrix.alias("menu_matrix_classification"),
        options.alias("dietary_options_score"),
        F.lit(True).alias("is_active"),
        "created_ts",
    )
    return run.audited(current)
