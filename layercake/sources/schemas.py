"""Declared schemas of the raw tables, and the source groups they belong to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names and types of the raw tables. Money has four decimals. JSON documents
# arrive as text and become VARIANT on load. Times of day stay text.
_COLUMNS = {
    "country": (
        "country_id BIGINT, country STRING, iso_currency STRING, iso_country STRING, "
        "city_id BIGINT, city STRING, city_population STRING"
    ),
    "franchise": (
        "franchise_id BIGINT, first_name STRING, last_name STRING, city STRING, country STRING, "
        "e_mail STRING, phone_number STRING"
    ),
    "location": (
        "location_id BIGINT, placekey STRING, location STRING, city STRING, region STRING, "
        "iso_country_code STRING, country STRING"
    ),
    "menu": (
        "menu_id BIGINT, menu_type_id BIGINT, menu_type STRING, truck_brand_name STRING, "
        "menu_item_id BIGINT, menu_item_name STRING, item_category STRING, item_subcategory STRING, "
        "cost_of_goods_usd DECIMAL(18,4), sale_price_usd DECIMAL(18,4), "
        "menu_item_health_metrics_obj STRING"
    ),
    "truck": (
        "truck_id BIGINT, menu_type_id BIGINT, primary_city STRING, region STRING, "
        "iso_region STRING, country STRING, iso_country_code STRING, franchise_flag INT, year INT, "
        "make STRING, model STRING, ev_flag INT, franchise_id BIGINT, truck_opening_date DATE"
    ),
    "order_header": (
        "order_id BIGINT, truck_id BIGINT, location_id DOUBLE, customer_id BIGINT, "
        "discount_id STRING, shift_id BIGINT, shift_start_time STRING, shift_end_time STRING, "
        "order_channel STRING, order_ts TIMESTAMP_NTZ, served_ts STRING, order_currency STRING, "
        "order_amount DECIMAL(18,4), order_tax_amount STRING, order_discount_amount STRING, "
        "order_total DECIMAL(18,4)"
    ),
    "order_detail": (
        "order_detail_id BIGINT, order_id BIGINT, menu_item_id BIGINT, discount_id STRING, "
        "line_number INT, quantity INT, unit_price DECIMAL(18,4), price DECIMAL(18,4), "
        "order_item_discount_amount STRING"
    ),
    "customer_loyalty": (
        "customer_id BIGINT, first_name STRING, last_name STRING, city STRING, country STRING, "
        "postal_code STRING, preferred_language STRING, gender STRING, favourite_brand STRING, "
        "marital_status STRING, children_count STRING, sign_up_date DATE, birthday_date DATE, "
        "e_mail STRING, phone_number STRING"
    ),
}

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(18,4)": T.DecimalType(18, 4),
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_SCHEMAS: dict[str, T.StructType] = {
    table: _schema(columns) for table, columns in _COLUMNS.items()
}

# Columns whose text is a JSON document.
JSON_COLUMNS = {"menu": ["menu_item_health_metrics_obj"]}


@dataclass(frozen=True)
class Source:
    """A declared source table; freshness limits in hours, None where none apply."""

    group: str
    description: str
    loaded_at: str | None = None
    warn_hours: int | None = 6
    error_hours: int | None = 12


# Source groups and freshness limits.
SOURCES: dict[str, Source] = {
    "country": Source("raw_pos", "countries and their cities, with codes and population"),
    "franchise": Source("raw_pos", "franchise owners and their contact details"),
    "location": Source("raw_pos", "places where trucks serve customers"),
    "menu": Source("raw_pos", "items with price, cost, category and nutrition"),
    "truck": Source("raw_pos", "vehicles of the fleet"),
    "order_header": Source("raw_pos", "one row per order", "order_ts", 2, 6),
    "order_detail": Source("raw_pos", "one row per order line"),
    "customer_loyalty": Source("raw_customer", "loyalty members", None, None, None),
}
