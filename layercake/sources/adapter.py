"""The raw tables, derived from a general orders-and-parts data set.

Tests and benchmarks run on such data. The expressions are plain SQL that other engines read too,
except that ``MINSEC(m; s)`` stands for an interval of m minutes and s seconds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Columns of the data set that are used, so that opening a table needs no look into its files.
BASE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
}

_CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT) % 8000"
_ORDER_TIME = (
    "o_orderdate + MINSEC(CAST((o_orderkey * 37) % 1440{late} AS INT); "
    "CAST((o_orderkey % 3) * 20 AS INT))"
)
_UNIT_PRICE = "CAST(CAST(p_size AS DECIMAL(18,0)) * CAST(0.50 AS DECIMAL(4,2)) AS DECIMAL(18,4))"
_QUANTITY = "CASE WHEN l_orderkey % 97 = 0 THEN 120 ELSE q % 5 END"


def _share(factor: str) -> str:
    return (
        f"CAST(CAST(CAST({_CENTS} AS DECIMAL(18,0)) * CAST({factor} AS DECIMAL(6,4)) "
        "AS DECIMAL(10,4)) AS STRING)"
    )


# Line numbers repeat within an order, so every row of the table is numbered within its order. Rows that
# agree in these columns are the same line to all that follows.
_LINE_ORDER = ("l_linenumber", "l_partkey", "l_quantity", "l_discount")
LINES = (
    "SELECT l_orderkey, l_linenumber, l_partkey AS pk, CAST(l_quantity AS INT) AS q, l_discount AS d, "
    f"ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) AS nth FROM lineitem"
)

# raw table: (table it comes from, {column: expression})
MAPPING: dict[str, tuple[str, dict[str, str]]] = {
    "country": ("nation", {
        "country_id": "CAST(n_regionkey AS BIGINT)",
        "country": "CASE n_regionkey WHEN 0 THEN ' united states ' WHEN 1 THEN 'uk' WHEN 2 THEN 'JAPAN' "
                   "WHEN 3 THEN 'australia' ELSE 'brazil' END",
        "iso_currency": "CASE n_regionkey WHEN 0 THEN 'usd' WHEN 1 THEN 'gbp' WHEN 2 THEN 'JPY' "
                        "WHEN 3 THEN 'AU' ELSE NULL END",
        "iso_country": "CASE n_regionkey WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'JP' "
                       "WHEN 3 THEN 'AU' ELSE CASE WHEN n_nationkey % 2 = 0 THEN 'BR' END END",
        "city_id": "CAST(n_nationkey AS BIGINT)",
        "city": "n_name",
        "city_population": "CAST(100000 * (n_nationkey + 1) AS STRING)",
    }),
    "location": ("nation", {
        "location_id": "CAST(n_nationkey AS BIGINT)",
        "placekey": "CONCAT(' pk-', CAST(n_nationkey AS STRING))",
        "location": "CASE n_nationkey % 8 WHEN 0 THEN 'central park' WHEN 1 THEN 'downtown plaza' "
                    "WHEN 2 THEN 'office row' WHEN 3 THEN 'state university' WHEN 4 THEN 'farmer market' "
                    "WHEN 5 THEN 'food festival' WHEN 6 THEN '  ' ELSE 'business mile' END",
        "city": "LOWER(n_name)",
        "region": "CONCAT('region ', CAST(n_regionkey AS STRING))",
        "iso_country_code": "CASE WHEN n_regionkey = 0 THEN ' us' ELSE 'gb ' END",
        "country": "CASE WHEN n_regionkey = 0 THEN 'united states' ELSE 'united kingdom' END",
    }),
    "franchise": ("supplier", {
        "franchise_id": "s_suppkey",
        "first_name": "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE ' aNN ' END",
        "last_name": "CONCAT('owner', CAST(s_suppkey AS STRING))",
        "city": "CONCAT(' city ', CAST(s_nationkey AS STRING))",
        "country": "'united states'",
        "e_mail": "CASE WHEN s_suppkey % 3 = 0 THEN 'not-an-address' "
                  "ELSE CONCAT('Owner', CAST(s_suppkey AS STRING), '@Example.com') END",
        "phone_number": "CONCAT('+1 (555) ', CAST(s_suppkey AS STRING), '-00')",
    }),
    "truck": ("supplier", {
        "truck_id": "s_suppkey",
        "menu_type_id": "s_suppkey % 5",
        "primary_city": "CONCAT('city ', CAST(s_nationkey AS STRING))",
        "region": "' north '",
        "iso_region": "'nr'",
        "country": "'united states'",
        "iso_country_code": "'us '",
        "franchise_flag": "CAST(s_suppkey % 2 AS INT)",
        "year": "CAST(1985 + s_suppkey % 18 AS INT)",
        "make": "'ford_'",
        "model": "'step van'",
        "ev_flag": "CAST(CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS INT)",
        "franchise_id": "s_suppkey",
        "truck_opening_date": "CASE s_suppkey % 5 WHEN 0 THEN DATE '2002-01-01' WHEN 1 THEN DATE '2001-07-01' "
                              "WHEN 2 THEN DATE '2001-01-15' WHEN 3 THEN DATE '1996-05-01' ELSE NULL END",
    }),
    "menu": ("part", {
        "menu_id": "p_partkey",
        "menu_type_id": "p_partkey % 5",
        "menu_type": "LOWER(p_type)",
        "truck_brand_name": "p_brand",
        "menu_item_id": "p_partkey",
        "menu_item_name": "CASE WHEN p_partkey % 20 = 0 THEN CONCAT('vegan ', p_name) "
                          "WHEN p_partkey % 20 = 1 THEN CONCAT('GF ', p_name) ELSE p_name END",
        "item_category": "CASE p_type WHEN 'STANDARD' THEN 'main' WHEN 'SMALL' THEN ' sides' "
                         "WHEN 'MEDIUM' THEN 'Drink' WHEN 'LARGE' THEN 'DESSERTS' "
                         "WHEN 'ECONOMY' THEN 'starter' ELSE 'promo box' END",
        "item_subcategory": "CONCAT('size ', CAST(p_size % 3 AS STRING))",
        "cost_of_goods_usd": "CAST(CAST(p_size * (p_partkey % 11) AS DECIMAL(18,0)) * "
                             "CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,4))",
        "sale_price_usd": _UNIT_PRICE,
        "menu_item_health_metrics_obj": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CONCAT('{\"calories\":', "
                                        "CAST(p_size * 20 AS STRING), ',\"vegan\":', "
                                        "CASE WHEN p_partkey % 4 = 0 THEN 'true' WHEN p_partkey % 4 = 1 "
                                        "THEN '\"true\"' ELSE 'false' END, '}') END",
    }),
    "customer_loyalty": ("customer", {
        "customer_id": "c_custkey",
        "first_name": "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE ' mARY' END",
        "last_name": "c_name",
        "city": "CONCAT('city ', CAST(c_nationkey AS STRING))",
        "country": "'france '",
        "postal_code": "CONCAT(' ab', CAST(c_custkey AS STRING))",
        "preferred_language": "CASE c_custkey % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'Spanish ' WHEN 2 THEN 'FRA' "
                              "WHEN 3 THEN 'ger' WHEN 4 THEN 'jap' ELSE 'dutch' END",
        "gender": "CASE c_custkey % 5 WHEN 0 THEN 'm' WHEN 1 THEN 'Female' WHEN 2 THEN 'o' WHEN 3 THEN 'n' "
                  "ELSE NULL END",
        "favourite_brand": "LOWER(c_mktsegment)",
        "marital_status": "CASE c_custkey % 5 WHEN 0 THEN 's' WHEN 1 THEN 'MARRIED' WHEN 2 THEN 'd' "
                          "WHEN 3 THEN ' w ' ELSE 'x' END",
        "children_count": "CASE WHEN c_custkey % 7 = 0 THEN 'Undisclosed' ELSE CAST(c_custkey % 4 AS STRING) END",
        "sign_up_date": "CAST(DATE '2001-08-01' - MINSEC(CAST((c_custkey % 900) * 1440 AS INT); 0) AS DATE)",
        "birthday_date": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(DATE '1990-12-31' - "
                         "MINSEC(CAST((c_custkey % 60) * 525600 AS INT); 0) AS DATE) END",
        "e_mail": "CASE WHEN c_custkey % 8 = 0 THEN 'bad@' WHEN c_custkey % 8 = 1 THEN ' pad@x.com' "
                  "ELSE CONCAT('C', CAST(c_custkey AS STRING), '@Mail.org') END",
        "phone_number": "CONCAT('(020) ', CAST(c_custkey AS STRING))",
    }),
    "order_header": ("orders", {
        "order_id": "o_orderkey",
        "truck_id": "o_orderkey % 10",
        "location_id": "CAST(o_orderkey % 26 AS DOUBLE)",
        "customer_id": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END",
        "discount_id": "CASE WHEN o_orderkey % 4 = 0 THEN ' D1 ' ELSE '' END",
        "shift_id": "o_orderkey % 3",
        "shift_start_time": "CAST(NULL AS STRING)",
        "shift_end_time": "CAST(NULL AS STRING)",
        "order_channel": "CASE o_orderkey % 8 WHEN 0 THEN 'mobile' WHEN 1 THEN ' App ' WHEN 2 THEN 'walkup' "
                         "WHEN 3 THEN 'WALK-UP' WHEN 4 THEN 'Web' WHEN 5 THEN 'phone' WHEN 6 THEN 'KIOSK' "
                         "ELSE 'drone' END",
        "order_ts": _ORDER_TIME.format(late=""),
        "served_ts": "CASE WHEN o_orderkey % 9 = 0 THEN ' ' WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST("
                     + _ORDER_TIME.format(late=" + o_orderkey % 17") + " AS STRING) END",
        "order_currency": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'usd' END",
        "order_amount": f"CAST(CAST({_CENTS} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(18,4))",
        "order_tax_amount": _share("0.0008"),
        "order_discount_amount": f"CASE WHEN o_orderkey % 4 = 0 THEN {_share('0.0010')} END",
        "order_total": f"CAST(CAST({_CENTS} AS DECIMAL(18,0)) * CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0.0098 "
                       "ELSE 0.0108 END AS DECIMAL(6,4)) AS DECIMAL(18,4))",
    }),
    "order_detail": ("lines", {
        "order_detail_id": "l_orderkey * 1000 + nth",
        "order_id": "l_orderkey",
        "menu_item_id": "pk",
        "discount_id": "CASE WHEN d > 0.05 THEN 'D2' ELSE ' ' END",
        "line_number": "l_linenumber",
        "quantity": _QUANTITY,
        "unit_price": _UNIT_PRICE,
        "price": f"CAST(CAST(p_size * ({_QUANTITY}) AS DECIMAL(18,0)) * CAST(0.50 AS DECIMAL(4,2)) + "
                 "CASE WHEN l_orderkey % 31 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4))",
        "order_item_discount_amount": "CASE l_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'n/a' "
                                      "WHEN 2 THEN '0.2500' ELSE NULL END",
    }),
}

def _spark_sql(expression: str) -> str:
    return expression.replace("MINSEC(", "make_dt_interval(0, 0, ").replace("; ", ", ")


def base_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def as_raw(rows: DataFrame, table: str) -> DataFrame:
    """A raw table from the rows it is derived from; works on streams too."""
    return rows.select(*[F.expr(_spark_sql(e)).alias(column) for column, e in MAPPING[table][1].items()])


class RawTables(Mapping):
    """The raw tables of a directory, each read when first asked for."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark, self._directory = spark, directory
        self._tables: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        return base_table(self._spark, self._directory, name)

    def _lines(self) -> DataFrame:
        in_order = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
        lines = self._read("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_partkey").alias("pk"), F.col("l_quantity").cast("int").alias("q"),
            F.col("l_discount").alias("d"), F.row_number().over(in_order).alias("nth"),
        )
        # A line of an unknown part stays, without a price.
        parts = self._read("part").select(F.col("p_partkey").alias("pk"), "p_size")
        return lines.join(parts, "pk", "left")

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            base = MAPPING[table][0]
            rows = as_raw(self._lines() if base == "lines" else self._read(base), table)
            if base == "lines":
                # Every line of an order has an id. Said so, lines are not numbered for readers that only ask whether there is one.
                there = F.when(F.col("order_id").isNotNull(), F.coalesce("order_detail_id", F.lit(0)))
                rows = rows.withColumn("order_detail_id", there)
            self._tables[table] = rows
        return self._tables[table]

    def __iter__(self):
        return iter(MAPPING)

    def __len__(self) -> int:
        return len(MAPPING)


def raw_tables(spark: SparkSession, directory: str) -> Mapping[str, DataFrame]:
    """The eight raw tables from ``directory/<table>.parquet``."""
    return RawTables(spark, directory)
