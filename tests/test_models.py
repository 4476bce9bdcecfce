"""Models on hand-made edge rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from layercake.plans import dimensions, intermediate, staging
from layercake.plans.facts import fact_order_detail
from layercake.sources import RAW_SCHEMAS

D = Decimal


def raw(spark, table, *rows, **defaults):
    """Rows of a raw table from dictionaries; what is not given is NULL."""
    schema = RAW_SCHEMAS[table]
    return spark.createDataFrame([[{**defaults, **r}.get(f) for f in schema.fieldNames()] for r in rows], schema)


def test_countries_without_code_or_name_are_left_out(spark, run):
    got = staging.stg_pos_countries(raw(
        spark, "country",
        dict(country_id=1, country="uk", iso_country="GB", iso_currency="gbp", city_id=1),
        dict(country_id=2, country="x", iso_country=None, city_id=2),
        dict(country_id=3, country="  ", iso_country="US", city_id=3),
        dict(country_id=4, country="new zealand", iso_country="NZL", iso_currency="AU", city_id=4),
    ), run).orderBy("country_id").collect()
    assert [(r.country_name, r.iso_country, r.iso_currency, r.region_name) for r in got] == [
        ("United Kingdom", "GB", "GBP", "Europe"), ("New Zealand", None, "USD", "Other")]


def test_order_headers_need_keys_a_time_and_a_total(spark, run):
    at = datetime(2001, 1, 7, 10, 0, 59)
    good = dict(order_id=1, truck_id=1, order_ts=at, order_total=D("5"), order_amount=D("4"),
                order_tax_amount="1.5", order_discount_amount=None, served_ts="2001-01-07 10:01:01")
    got = staging.stg_pos_order_headers(raw(
        spark, "order_header", good, {**good, "order_id": 2, "order_total": D("0")},
        {**good, "order_id": 3, "truck_id": None}, {**good, "order_id": 4, "order_ts": None},
        {**good, "order_id": 5, "served_ts": " ", "order_discount_amount": "1"}), run).orderBy("order_id").collect()
    assert [r.order_id for r in got] == [1, 5]
    assert got[0].processing_time_minutes == 1 and got[1].processing_time_minutes is None
    assert got[0].discount_percentage == 0.0 and got[1].discount_percentage == 25.0
    assert got[0].order_day_of_week == 0 and got[0].order_currency == "USD"


def test_order_details_clamp_discounts_and_flags(spark, run):
    row = dict(order_id=1, menu_item_id=1, unit_price=D("5.00"), price=D("10.01"), quantity=2)
    cases = [
        {**row, "order_detail_id": 1},
        {**row, "order_detail_id": 2, "price": D("10.02"), "order_item_discount_amount": "n/a"},
        {**row, "order_detail_id": 3, "quantity": 0},
        {**row, "order_detail_id": 4, "quantity": 100, "order_item_discount_amount": "0.25"},
        {**row, "order_detail_id": 5, "price": None},
    ]
    got = {r.order_detail_id: r for r in staging.stg_pos_order_details(
        raw(spark, "order_detail", *cases), run).collect()}
    assert sorted(got) == [1, 2, 4, 5]
    assert got[1].price_quantity_consistent and not got[2].price_quantity_consistent
    assert got[2].line_discount_amount == 0 and got[2].line_discount_percentage is None
    assert got[4].quantity == 99 and got[4].net_line_total == D("9.76")
    assert (got[5].line_total, got[5].net_line_total, got[5].is_valid_line_item) == (0, None, False)


@pytest.mark.parametrize(
    "opening, status, days, maturity, category",
    [(date(2002, 1, 1), "Planned", 0, "Pre-Launch", "Pre-Launch"),
     (date(2001, 8, 2), "Active", 0, "New Truck", "Inactive"),
     (date(2001, 8, 1), "Active", 1, "New Truck", "New Launch"),
     (date(2000, 8, 2), "Active", 365, "Established", "Established Performer"),
     (None, "Unknown", 0, "Mature", "Inactive")])
def test_truck_status(spark, run, opening, status, days, maturity, category):
    staged = staging.stg_pos_trucks(raw(spark, "truck", dict(
        truck_id=1, truck_opening_date=opening, year=1998, franchise_flag=0, franchise_id=5, ev_flag=0)), run)
    got = staged.first()
    assert (got.operational_status, got.days_in_operation, got.truck_maturity) == (status, days, maturity)
    owners = spark.createDataFrame([(5, "k5")], "franchise_id bigint, franchise_sk string")
    truck = dimensions.dim_truck(staged, owners, run).first()
    assert (truck.operational_category, truck.franchise_sk, truck.sustainability_score) == (category, None, 80)


def test_menu_margin_flags_and_pricing(spark, run):
    row = dict(menu_id=1, menu_type_id=1, item_category="ENTREES")
    cases = [
        {**row, "menu_item_id": 1, "menu_item_name": "x", "sale_price_usd": D("0"), "cost_of_goods_usd": D("0")},
        {**row, "menu_item_id": 2, "menu_item_name": "vegan x", "sale_price_usd": D("5"), "cost_of_goods_usd": D("5")},
        {**row, "menu_item_id": 3, "menu_item_name": "x", "sale_price_usd": D("5")},
        {**row, "menu_item_id": 4, "menu_item_name": "x gf", "sale_price_usd": D("5"), "cost_of_goods_usd": D("2"),
         "menu_item_health_metrics_obj": '{"vegan":"true","calories":12.6}'},
        {**row, "menu_item_id": 5, "menu_item_name": " "},
    ]
    got = staging.stg_pos_menu(raw(spark, "menu", *cases), run).orderBy("menu_item_id").collect()
    assert [(r.has_valid_pricing, r.profit_margin_pct) for r in got] == [
        (False, 0.0), (False, 0.0), (False, 100.0), (True, 60.0)]
    assert [r.is_vegan for r in got] == [False, True, False, True]
    assert got[3].is_gluten_free and got[3].calories == 13 and got[3].item_category == "Main Dish"


def order(order_id, day, total, customer=1, channel="app"):
    return dict(order_id=order_id, truck_id=1, customer_id=customer, order_ts=datetime(*day), order_channel=channel,
                order_total=D(total), order_amount=D(total), location_id=1.0)


def segmented(spark, run, *orders):
    headers = staging.stg_pos_order_headers(raw(spark, "order_header", *orders), run)
    details = staging.stg_pos_order_details(raw(spark, "order_detail"), run)
    menu = staging.stg_pos_menu(raw(spark, "menu"), run)
    people = staging.stg_customer_loyalty(raw(
        spark, "customer_loyalty", dict(customer_id=1, sign_up_date=date(2000, 1, 1))), run)
    return intermediate.int_customers_segmented(
        people, intermediate.int_orders_enriched(headers, details, menu, run), run).first()


def test_lifetime_value(spark, run):
    same_day = segmented(spark, run, order(1, (2001, 7, 1), "10"), order(2, (2001, 7, 1), "30"))
    assert same_day.estimated_lifetime_value == 60 and same_day.customer_segment == "New"
    paced = segmented(spark, run, order(1, (2001, 1, 1), "10"), order(2, (2001, 3, 15), "10"))
    assert paced.avg_days_between_orders == 73 and paced.estimated_lifetime_value == 100
    none = segmented(spark, run, order(1, (2001, 1, 1), "10", customer=2))
    assert none.estimated_lifetime_value == 0 and none.days_since_last_order == 9999
    assert none.customer_segment == "Occasional" and none.first_order_date is None


def test_repeated_order_rows_count_once(spark, run):
    one = order(1, (2001, 7, 1), "10")
    got = segmented(spark, run, one, one, order(2, (2001, 7, 3), "10", channel="web"))
    assert (got.total_orders, got.mobile_orders, got.total_spent) == (2, 1, 30)


def test_cities_take_the_zone_of_their_country_once(spark, run):
    rows = [dict(country_id=1, country="japan", iso_country="JP", city_id=i % 3, city=f"c{i % 3}") for i in range(9)]
    staged = staging.stg_pos_countries(raw(spark, "country", *rows), run)
    got = dimensions.dim_city(staged, run).orderBy("city_id").collect()
    assert [(r.city_id, r.timezone) for r in got] == [(0, "Asia/Tokyo"), (1, "Asia/Tokyo"), (2, "Asia/Tokyo")]
    assert dimensions.dim_country(staged, run).count() == 1


def test_lines_of_unknown_orders_and_items(spark, run):
    row = dict(quantity=2, unit_price=D("5"), price=D("10"))
    details = staging.stg_pos_order_details(raw(
        spark, "order_detail", {**row, "order_detail_id": 1, "order_id": 1, "menu_item_id": 1},
        {**row, "order_detail_id": 2, "order_id": 9, "menu_item_id": 9}), run)
    orders = spark.createDataFrame([(1,)], "order_id bigint")
    menu = staging.stg_pos_menu(raw(spark, "menu", dict(
        menu_item_id=1, menu_item_name="x", sale_price_usd=D("5"), cost_of_goods_usd=D("2"))), run)
    items = dimensions.key_table(menu, "menu_item_id", "menu_item_sk", (
        "cost_of_goods_usd", "item_category", "item_subcategory", "truck_brand_name", "is_vegetarian",
        "is_vegan", "is_gluten_free"))
    known, unknown = fact_order_detail(details, orders, items, run).orderBy("order_detail_id").collect()
    assert known.order_sk != "-1" and known.menu_item_sk != "-1" and known.line_profit == 6
    assert (unknown.order_sk, unknown.menu_item_sk, unknown.line_cost_of_goods) == ("-1", "-1", 0)
    assert known.line_profit_margin_pct == 60.0
