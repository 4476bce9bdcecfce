"""The single-operator queries as SQL, with the columns both engines deliver."""

from __future__ import annotations

from layercake import rules
from layercake.plans.operator_queries import DOCUMENT, LINE_COLUMNS
from layercake.quality.catalogue import RULES
from layercake.quality.checks import Rule
from oracle.models import SPECS as MODEL_SPECS
from oracle.models import code, digits, email, full_name, lifetime
from oracle.sql import (
    AS_OF,
    CTES,
    any_word,
    case_band,
    case_between,
    case_in,
    case_rules,
    case_words,
    cte,
    deliver,
    initcap,
    key,
    listed,
    model,
    pct,
    peak,
    query,
    text,
)

SPECS: dict[str, str] = {}
SQL: dict[str, str] = {}


def register(name: str, spec: str, sql: str, needs: str = "") -> None:
    SPECS[name] = spec
    SQL[name] = query(f"SELECT {deliver(spec)} FROM ({sql})", *needs.split())


register("dim_date", MODEL_SPECS["dim_date"] + " orders:l revenue:m", """
    SELECT d.*, coalesce(orders, 0) AS orders, revenue FROM dim_date d LEFT JOIN (
        SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
            sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY 1) ON day = date_actual""",
         "dim_date")
register("dim_time", MODEL_SPECS["dim_time"] + " events:l users:l", """
    SELECT t.*, coalesce(events, 0) AS events, coalesce(users, 0) AS users FROM dim_time t LEFT JOIN (
        SELECT hour(ts) * 100 + minute(ts) AS m, count(*) AS events, count(DISTINCT user_id) AS users
        FROM events GROUP BY 1) ON m = time_sk""", "dim_time")

register("normalize_labels", "channel:s orders:l revenue:m", f"""
    SELECT {case_in(code("order_channel"), rules.CHANNELS, "'Other'")} AS channel, count(*) AS orders,
        sum(order_total) AS revenue FROM raw_order_header GROUP BY 1""", "raw_order_header")
register("band_labels", "o_orderkey:l age_band:s value_band:s half:s", f"""
    SELECT o_orderkey,
        {case_band(f"date_diff('day', o_orderdate, {AS_OF})", "<=", rules.TENURE_MAX, "Veteran")} AS age_band,
        {case_band("o_totalprice / 1000", ">=", rules.VALUE_TIER_MIN, "Minimal Value")} AS value_band,
        CASE WHEN month(o_orderdate) <= 6 THEN 'First half' ELSE 'Second half' END AS half FROM orders""")
register("keyword_classify", "p_partkey:l kind:s is_coloured:b", f"""
    SELECT p_partkey, {case_words("upper(p_name)", [(["RING", "GEAR"], "Round"), (["WIDGET", "GADGET"], "Device"),
                                                   (["BOLT", "NUT"], "Fastener")], "'Other'")} AS kind,
        {any_word("upper(p_name)", ["RED", "BLUE"])} AS is_coloured FROM part""")
register("clean_text", "customer_id:l full_name:s email:s phone:s postal_code:s country:s children:i", f"""
    SELECT customer_id, {full_name("first_name", "last_name")} AS full_name, {email("e_mail")} AS email,
        {digits("phone_number")} AS phone, {code("r.postal_code")} AS postal_code,
        {initcap("r.country")} AS country,
        CASE WHEN try_cast(children_count AS INT) >= 2 THEN 2 ELSE 1 END AS children
    FROM raw_customer_loyalty r""", "raw_customer_loyalty")
register("surrogate_keys", "order_id:l order_sk:s pair_sk:s", f"""
    SELECT order_id, {key("order_id")} AS order_sk, {key("truck_id", "customer_id")} AS pair_sk
    FROM raw_order_header""", "raw_order_header")

_line_spec = (
    "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d "
    "l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t"
)
_ties = ", ".join(n for n in LINE_COLUMNS if n not in ("l_orderkey", "l_linenumber"))
register("keep_latest", _line_spec, f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, {_ties}) = 1""")
register("left_join_preserved_cond", "c_custkey:l c_acctbal:d s_name:s",
         "SELECT c_custkey, c_acctbal, s_name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey AND c_acctbal > 0")
register("unknown_member", "customer_sk:s location_sk:s orders:l revenue:m", f"""
    SELECT CASE WHEN c.customer_id IS NULL THEN '{rules.UNKNOWN_KEY}' ELSE {key("c.customer_id")} END AS customer_sk,
        CASE WHEN l.location_id IS NULL THEN '{rules.UNKNOWN_KEY}' ELSE {key("l.location_id")} END AS location_sk,
        count(*) AS orders, sum(order_total) AS revenue
    FROM raw_order_header o LEFT JOIN stg_customer_loyalty c ON o.customer_id = c.customer_id
        LEFT JOIN stg_pos_locations l ON o.location_id = l.location_id GROUP BY 1, 2""",
         "raw_order_header stg_customer_loyalty stg_pos_locations")

register("cond_distinct", "l_suppkey:l orders:l returned_orders:l discounted_orders:l large_orders:l quantity:l", """
    SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders,
        count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned_orders,
        count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS discounted_orders,
        count(DISTINCT CASE WHEN l_quantity >= 40 THEN l_orderkey END) AS large_orders,
        sum(CAST(l_quantity AS BIGINT)) AS quantity FROM lineitem GROUP BY l_suppkey""")
register("mode_det", "l_suppkey:l usual_quantity:i", """
    SELECT l_suppkey, CAST(l_quantity AS INT) AS usual_quantity FROM lineitem GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, CAST(l_quantity AS INT)) = 1""")
register("median_price", "l_returnflag:s l_linestatus:s median_price:m", """
    SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.5) AS median_price
    FROM lineitem GROUP BY 1, 2""")
register("distinct_list", "l_orderkey:l flags:s lines:l discounted_pct:m", f"""
    SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS flags,
        count(*) AS lines, {pct("count(*) FILTER (l_discount > 0)", "count(*)")} AS discounted_pct
    FROM lineitem GROUP BY l_orderkey""")
register("customer_preferences",
         "customer_sk:s favorite_category:s favorite_subcategory:s favorite_brand:s "
         "vegetarian_items_ordered:l vegan_items_ordered:l gluten_free_items_ordered:l total_items_ordered:l "
         "avg_item_price_preference:m median_item_price_preference:m", "SELECT * FROM customer_tastes",
         "customer_tastes")

register("rank_by_day", "o_orderkey:l o_totalprice:d order_day:D day_rank:i", """
    SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day, row_number() OVER (
        PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_totalprice DESC, o_orderkey) AS day_rank FROM orders""")
cte("nation_days", "", """
    SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day,
        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(*) AS orders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
_series = "(PARTITION BY nation ORDER BY day ROWS 6 PRECEDING)"
register("rolling_avg_7", "nation:l day:D revenue:m orders:l revenue_avg:m orders_avg:m", f"""
    SELECT *, avg(revenue) OVER {_series} AS revenue_avg, avg(orders) OVER {_series} AS orders_avg
    FROM nation_days""", "nation_days")
register("lag7_growth", "nation:l day:D revenue:m orders:l revenue_before:m growth_pct:m", f"""
    SELECT *, {pct("(revenue - revenue_before)", "revenue_before")} AS growth_pct FROM (
        SELECT *, lag(revenue, 7) OVER (PARTITION BY nation ORDER BY day) AS revenue_before FROM nation_days)""",
         "nation_days")
register("first_value_month", "nation:l day:D best_weekday:s", """
    SELECT nation, day, first_value(dayname(day)) OVER (PARTITION BY nation, date_trunc('month', day)
        ORDER BY revenue DESC, day) AS best_weekday FROM nation_days""", "nation_days")
_month = "(PARTITION BY nation, date_trunc('month', day))"
register("weekend_weekday_avg", "nation:l day:D weekend:m weekday:m ratio:m", f"""
    SELECT nation, day, avg(revenue) FILTER (dayofweek(day) IN (0, 6)) OVER {_month} AS weekend,
        avg(revenue) FILTER (dayofweek(day) NOT IN (0, 6)) OVER {_month} AS weekday,
        CASE WHEN weekday > 0 THEN weekend / weekday ELSE 0 END AS ratio FROM nation_days""", "nation_days")
_season = case_in("month(day)", rules.SEASONS, "'Fall'")
register("season_avg", "nation:l day:D season:s season_avg:m", f"""
    SELECT nation, day, {_season} AS season, avg(revenue) OVER (PARTITION BY nation, {_season}) AS season_avg
    FROM nation_days""", "nation_days")
_parts = [label for _, label in rules.DAY_PARTS]
_part_counts = ", ".join(f"count(*) FILTER (part = {text(p)}) AS n{i}" for i, p in enumerate(_parts))
register("peak_period", "user_id:l events:l peak:s", f"""
    SELECT user_id, events, {peak([(p, f"n{i}") for i, p in enumerate(_parts)])} AS peak FROM (
        SELECT user_id, count(*) AS events, {_part_counts} FROM (
            SELECT user_id, {case_between("hour(ts)", rules.DAY_PARTS, "Night")} AS part FROM events)
        GROUP BY user_id)""")

_in_90 = f"CAST(o_orderdate AS DATE) >= {AS_OF} - INTERVAL {rules.RECENT_DAYS} DAY"
register("recency_90d", "o_custkey:l recent_orders:l recent_spent:m days_since_last:i", f"""
    SELECT o_custkey, count(*) FILTER ({_in_90}) AS recent_orders,
        coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER ({_in_90}), 0) AS recent_spent,
        date_diff('day', max(CAST(o_orderdate AS DATE)), {AS_OF}) AS days_since_last
    FROM orders GROUP BY o_custkey""")
cte("plain_history", "stg_pos_order_headers", f"""
    SELECT customer_id, count(DISTINCT order_id) AS n, sum(order_total) AS total,
        CAST(sum(order_total) AS DOUBLE) / count(order_total) AS mean,
        date_diff('day', max(CAST(order_timestamp AS DATE)), {AS_OF}) AS recency,
        CASE WHEN count(DISTINCT order_id) > 1 THEN CAST(date_diff('day', min(CAST(order_timestamp AS DATE)),
            max(CAST(order_timestamp AS DATE))) AS DOUBLE) / (count(DISTINCT order_id) - 1) END AS gap
    FROM stg_pos_order_headers WHERE customer_id IS NOT NULL GROUP BY customer_id""")
register("rfm_segment", "customer_id:l total_orders:l total_spent:m gap:m value:m segment:s", f"""
    SELECT customer_id, n AS total_orders, total AS total_spent, gap, {lifetime("n", "total", "mean", "gap", "0")} AS value,
        {case_rules(rules.SEGMENTS, "Occasional", recency="recency", orders="n", spent="total",
                    signup="CAST(NULL AS INT)")} AS segment FROM plain_history""", "plain_history")

register("json_extract", "event_type:s with_k:l sum_k:l without_absent:l", """
    SELECT event_type, count(json_extract_string(props, '$.k')) AS with_k,
        sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS sum_k,
        count(*) FILTER (json_extract_string(props, '$.absent') IS NULL) AS without_absent
    FROM events GROUP BY event_type""")
cte("docs", "", f"""
    SELECT concat('feed_', p_partkey) AS feed_name, CAST({DOCUMENT} AS JSON) AS doc,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey) AS loaded_at FROM part""")
cte("items", "docs", """
    SELECT feed_name, loaded_at, doc, i AS index, doc->'$.tasks'->CAST(i AS INT) AS item
    FROM docs, unnest(range(CAST(json_array_length(doc, '$.tasks') AS BIGINT))) u(i)""")
_enabled = "coalesce(CAST(item->>'$.enabled' AS BOOLEAN), true)"
register("json_explode", "feed_name:s index:i task_name:s enabled:b dbt_command:s schedule:s depends_on:s", f"""
    SELECT feed_name, index, item->>'$.name' AS task_name, {_enabled} AS enabled,
        item->>'$.dbt_command' AS dbt_command, item->>'$.schedule' AS schedule,
        array_to_string(CAST(item->'$.depends_on' AS VARCHAR[]), ',') AS depends_on FROM items""", "items")
register("feed_summary", "feed_name:s loaded_at:t total_tasks:i enabled_tasks:l disabled_tasks:l", f"""
    SELECT feed_name, loaded_at, count(*) AS total_tasks, count(*) FILTER ({_enabled}) AS enabled_tasks,
        count(*) FILTER (NOT {_enabled}) AS disabled_tasks FROM items GROUP BY feed_name, loaded_at""", "items")
register("document_validate", "feed_name:s is_valid:b message:s", """
    SELECT feed_name, fault IS NULL AS is_valid,
        coalesce('Error: ' || fault, 'Configuration is valid') || ' for feed: ' || feed_name AS message
    FROM (SELECT feed_name, CASE
            WHEN doc->>'$.project_config.project_name' IS NULL THEN 'Missing required field: project_config.project_name'
            WHEN json_array_length(doc, '$.tasks') = 0 THEN 'Missing or empty tasks array'
            WHEN doc->>'$.tasks[1].dbt_command' IS NULL THEN 'Task 2 is missing dbt_command field' END AS fault
        FROM docs)""", "docs")
register("document_newest", "feed_name:s is_valid:b message:s", """
    SELECT feed_name, fault IS NULL AS is_valid,
        coalesce('Error: ' || fault, 'Configuration is valid') || ' for feed: ' || feed_name AS message
    FROM (SELECT feed_name, CASE
            WHEN doc->>'$.project_config.project_name' IS NULL THEN 'Missing required field: project_config.project_name'
            WHEN json_array_length(doc, '$.tasks') = 0 THEN 'Missing or empty tasks array'
            WHEN doc->>'$.tasks[1].dbt_command' IS NULL THEN 'Task 2 is missing dbt_command field' END AS fault
        FROM docs)""", "docs")
register("document_replace", "feed_name:s has_data:b loaded_at:t", """
    SELECT feed_name, true AS has_data, CASE WHEN CAST(substr(feed_name, 6) AS BIGINT) % 2 = 0
        THEN loaded_at + INTERVAL 1 DAY ELSE loaded_at END AS loaded_at FROM docs""", "docs")
register("dependency_filter", "feed_name:s index:i task_name:s depends_on:s", f"""
    SELECT i.feed_name, i.index, i.item->>'$.name' AS task_name, array_to_string(list_filter(
            CAST(i.item->'$.depends_on' AS VARCHAR[]), lambda d: list_contains(e.enabled, d)), ',') AS depends_on
    FROM items i JOIN (SELECT feed_name, list(item->>'$.name') FILTER ({_enabled}) AS enabled
        FROM items GROUP BY feed_name) e ON i.feed_name = e.feed_name
    WHERE {_enabled.replace("item->", "i.item->")}""", "items")

_order_spec = "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderdate:t"
_loaded = "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '2001-01-01')"
register("hwm_filter", _order_spec, f"SELECT * FROM orders WHERE o_orderdate > {_loaded}")
register("hwm_by_id", "order_detail_id:l order_id:l price:m", """
    SELECT * FROM raw_order_detail WHERE order_detail_id > (
        SELECT max(order_detail_id) FROM raw_order_detail WHERE order_detail_id % 3 = 0 AND price < 5)""",
         "raw_order_detail")
_upserted = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1
        ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate
    FROM orders WHERE o_orderstatus = 'O'"""
register("incremental_upsert", _order_spec, _upserted)
register("incremental_table", _order_spec, _upserted)
register("stream_upsert", MODEL_SPECS["stg_pos_order_headers"], "SELECT * FROM stg_pos_order_headers",
         "stg_pos_order_headers")
register("schema_sync", "o_orderkey:l o_custkey:l o_totalprice:d o_orderdate:t o_orderpriority:s", """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
        CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""")
register("csv_load",
         "menu_id:l menu_type_id:l menu_type:s truck_brand_name:s menu_item_id:l menu_item_name:s "
         "item_category:s item_subcategory:s cost_of_goods_usd:m sale_price_usd:m calories:l", """
    SELECT *, CAST(json_extract_string(menu_item_health_metrics_obj, '$.calories') AS BIGINT) AS calories
    FROM raw_menu""", "raw_menu")
register("key_members", "customer_id:l customer_sk:s",
         f"SELECT DISTINCT customer_id, {key('customer_id')} AS customer_sk FROM stg_pos_order_headers "
         "WHERE customer_id IS NOT NULL", "stg_pos_order_headers")

# ------------------------------------------------------------------------------------- data quality
_result = "model:s column:s test:s severity:s failures:l"


def failing(rule: Rule, source: str) -> str:
    """Number of failing rows of one test."""
    where = f"({rule.where})" if rule.where else "true"
    col = rule.column
    if rule.test == "unique":
        return (
            f"(SELECT count(*) FROM (SELECT {col} FROM {source} WHERE {col} IS NOT NULL AND {where} "
            f"GROUP BY {col} HAVING count(*) > 1))"
        )
    if rule.test == "relationships":
        return (
            f"(SELECT count(*) FROM {source} c WHERE {where} AND c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {rule.parent} p WHERE p.{rule.field} = c.{col}))"
        )
    bad = {
        "not_null": f"{col} IS NULL",
        "accepted_values": f"{col} NOT IN {listed(rule.values)}" if rule.values else "",
        "accepted_range": " OR ".join(
            [f"CAST({col} AS DOUBLE) < {rule.low}"] * (rule.low is not None)
            + [f"CAST({col} AS DOUBLE) > {rule.high}"] * (rule.high is not None)
        ),
        "expression_is_true": f"NOT ({rule.expression})",
    }[rule.test]
    return f"(SELECT count(*) FROM {source} WHERE {where} AND ({bad}))"


def suite(model: str, tests: list[Rule], source: str | None = None) -> str:
    return " UNION ALL ".join(
        f"SELECT {text(model)} AS model, {text(r.column)} AS \"column\", {text(r.test)} AS test, "
        f"{text(r.severity)} AS severity, {failing(r, source or model)} AS failures" for r in tests
    )


def register_suite(name: str, sql: str, needs: str = "") -> None:
    SPECS[name] = _result
    columns = deliver(_result).replace("CAST(column AS VARCHAR) AS column", 'CAST("column" AS VARCHAR) AS "column"')
    SQL[name] = query(f"SELECT {columns} FROM ({sql})", *needs.split())


register_suite("dq_unique", suite("lineitem", [
    Rule("l_orderkey", "unique"), Rule("l_partkey", "unique", where="l_quantity > 49")]))
register_suite("dq_not_null", suite("order_header", [
    Rule(n, "not_null") for n in ("order_id", "customer_id", "order_currency", "served_ts")],
    "raw_order_header"), "raw_order_header")
register_suite("dq_accepted", suite("orders", [
    Rule("o_orderstatus", "accepted_values", values=("F", "O")),
    Rule("o_orderpriority", "accepted_values", values=("1-URGENT", "2-HIGH"), severity="warn")]))
register_suite("dq_range", suite("lineitem", [
    Rule("l_quantity", "accepted_range", low=5, high=45),
    Rule("l_extendedprice", "accepted_range", high=50000, where="l_returnflag = 'R'")]))
register_suite("dq_relationship", suite("order_header", [
    Rule("customer_id", "relationships", parent="(SELECT * FROM raw_customer_loyalty WHERE customer_id % 3 <> 0)",
         field="customer_id")], "raw_order_header"), "raw_order_header raw_customer_loyalty")
register_suite("dq_expression", suite("lineitem", [
    Rule("tax_below_discount", "expression_is_true", expression="l_tax <= l_discount", severity="warn"),
    Rule("price_per_unit", "expression_is_true", expression="l_extendedprice / l_quantity < 5000",
         where="l_quantity > 1")]))
_silver = ["stg_pos_order_headers", "stg_pos_order_details", "int_orders_enriched",
           "int_menu_profitability", "int_customers_segmented"]
register_suite("dq_suite", " UNION ALL ".join(suite(m, RULES[m]) for m in _silver), " ".join(_silver))

_marts = ["agg_daily_sales", "agg_location_insights", "agg_menu_performance", "agg_customer_360"]
_core = [m for m in RULES if m not in (*_silver, *_marts)]
register_suite("dq_core", " UNION ALL ".join(suite(m, RULES[m]) for m in _core), " ".join(RULES))
register_suite("dq_marts", " UNION ALL ".join(suite(m, RULES[m]) for m in _marts), " ".join(RULES))

# The marts over order headers of which a tenth comes twice.
_headers = CTES["raw_order_header"][1]
for _name in _marts:
    SPECS[f"{_name}_repeats"] = MODEL_SPECS[_name]
    SQL[f"{_name}_repeats"] = model(_name, MODEL_SPECS[_name]).replace(
        f"raw_order_header AS ({_headers})",
        f"raw_order_header AS ({_headers} UNION ALL SELECT * FROM ({_headers}) WHERE order_id % 10 = 0)",
    )

register("source_freshness", "source:s loaded_at:t age_hours:m status:s", """
    SELECT source, loaded_at, age_hours, CASE WHEN age_hours > error THEN 'error'
        WHEN age_hours > warn THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT source, loaded_at, warn, error, date_diff('second', date_trunc('second', loaded_at), now) / 3600.0 AS age_hours FROM (
        SELECT 'events' AS source, max(ts) AS loaded_at, 6 AS warn, 12 AS error,
            TIMESTAMP '2024-01-31' AS now FROM events
        UNION ALL SELECT 'orders', max(o_orderdate), 48, 72, TIMESTAMP '2001-08-02' FROM orders))""")

register("declared_freshness_of_sources", "source:s loaded_at:t age_hours:m status:s", """
    SELECT 'order_header' AS source, loaded_at, age AS age_hours,
        CASE WHEN age > 6 THEN 'error' WHEN age > 2 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(order_ts) AS loaded_at,
        date_diff('second', date_trunc('second', max(order_ts)), TIMESTAMP '2001-08-02') / 3600.0 AS age
        FROM raw_order_header)""", "raw_order_header")
register("audit_columns", "order_id:l created_ts:t updated_ts:t", """
    SELECT order_id, TIMESTAMP '2001-08-02' AS created_ts, TIMESTAMP '2001-08-02' AS updated_ts FROM fact_order""",
         "fact_order")
register("views_and_sources", "truck_id:l orders:l total:m", """
    SELECT truck_id, count(*) AS orders, sum(order_total) AS total FROM raw_order_header GROUP BY truck_id""",
         "raw_order_header")
register("built_headers", MODEL_SPECS["stg_pos_order_headers"], "SELECT * FROM stg_pos_order_headers",
         "stg_pos_order_headers")

# ------------------------------------------------------------------------------ loads, marks, builds
register("csv_load_bad", "folder:s row:s", """
    SELECT 'good' AS folder, CAST(truck_id AS VARCHAR) AS "row" FROM raw_truck
    UNION ALL SELECT 'bad', 'no number,' || s_suppkey FROM supplier""", "raw_truck")
SQL["csv_load_bad"] = SQL["csv_load_bad"].replace("CAST(row AS", 'CAST("row" AS').replace("AS row", 'AS "row"')
register("catalog_view_of_orders", "o_custkey:l orders:l total:m", """
    SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey""")
register("documents_from_files", "project:s index:i task_name:s enabled:b loaded_at:t named_after_file:b", """
    SELECT n_name AS project, row_number() OVER (PARTITION BY n_name ORDER BY c_mktsegment) - 1 AS index,
        c_mktsegment AS task_name, count(*) % 2 = 0 AS enabled, TIMESTAMP '2024-01-02' AS loaded_at,
        true AS named_after_file
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""")
for _listing, _of in (("ordered_feeds", "feed_summary"), ("ordered_tasks", "json_explode")):
    SPECS[_listing], SQL[_listing] = SPECS[_of], SQL[_of]
SPECS["ordered_tasks"] = "feed_name:s index:i task_name:s enabled:b"
SQL["ordered_tasks"] = f"SELECT feed_name, index, task_name, enabled FROM ({SQL['json_explode']})"
register("menu_health_metrics", "menu_item_id:l health_metrics:s", """
    SELECT menu_item_id, menu_item_health_metrics_obj AS health_metrics FROM raw_menu
    WHERE menu_item_id IN (SELECT menu_item_id FROM stg_pos_menu)""", "raw_menu stg_pos_menu")
_raw = ["country", "franchise", "location", "menu", "truck", "order_header", "order_detail", "customer_loyalty"]
register("loaded_tables", "name:s was_there:b is_there:b n_rows:l note:s", " UNION ALL ".join(
    f"SELECT '{name}' AS name, false AS was_there, true AS is_there, count(*) AS n_rows, 'loaded' AS note FROM raw_{name}"
    for name in _raw), " ".join(f"raw_{name}" for name in _raw))
register("hwm_from_footers", _order_spec, """
    SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders
        WHERE o_orderkey % 3 = 0 AND o_orderdate <= TIMESTAMP '2000-01-01')""")
register("freshness_from_footers", "loaded_at:t age_hours:m status:s", """
    SELECT loaded_at, age_hours, CASE WHEN age_hours > 72 THEN 'error' WHEN age_hours > 48 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(o_orderdate) AS loaded_at,
        date_diff('second', date_trunc('second', max(o_orderdate)), TIMESTAMP '2001-08-02') / 3600.0 AS age_hours FROM orders)""")
register("built_facts", MODEL_SPECS["fact_order_detail"], "SELECT * FROM fact_order_detail", "fact_order_detail")
_stopping = ["int_orders_enriched", "int_menu_profitability", "int_customers_segmented"]
register_suite("gated_build", "SELECT * FROM (" + " UNION ALL ".join(suite(m, RULES[m]) for m in _stopping)
               + ") WHERE failures > 0 AND severity = 'error'", " ".join(_stopping))
for _mart in ("daily_sales", "location_insights", "menu_performance"):
    SPECS[f"{_mart}_by_increments"] = MODEL_SPECS[f"agg_{_mart}"]
    SQL[f"{_mart}_by_increments"] = model(f"agg_{_mart}", MODEL_SPECS[f"agg_{_mart}"])
register("members_by_period", "period:s of:s start:D members:l", " UNION ALL ".join(
    f"""SELECT '{period}' AS period, '{name}' AS "of", CAST(date_trunc('{period}', order_ts) AS DATE) AS start,
        count(DISTINCT {member}) AS members FROM raw_order_header WHERE {member} IS NOT NULL GROUP BY 3"""
    for member, name in (("customer_id", "customers"), ("truck_id", "trucks")) for period in ("day", "month", "year")),
         "raw_order_header")
SQL["members_by_period"] = SQL["members_by_period"].replace("CAST(of AS VARCHAR) AS of", 'CAST("of" AS VARCHAR) AS "of"')
register("catalog_increments", "o_orderkey:l o_totalprice:d o_orderpriority:s", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""")
