"""Column functions on edge rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules

c = F.col


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression.alias("y")).collect()]


def test_channel_synonyms(spark):
    got = column(spark, "string", [" App ", "WALK_UP", "web", "call", "Self-Service", "drone", None],
                 fn.normalize(fn.code(c("x")), rules.CHANNELS, "Other"))
    assert got == ["Mobile App", "Walk-up", "Online", "Phone", "Kiosk", "Other", "Other"]


def test_meal_hours(spark):
    got = column(spark, "int", [5, 6, 10, 11, 14, 15, 17, 18, 21, 22, None],
                 fn.between_band(c("x"), rules.MEAL_HOURS, "Late Night"))
    assert got == ["Late Night", "Breakfast", "Breakfast", "Lunch", "Lunch", "Snack", "Snack", "Dinner",
                   "Dinner", "Late Night", "Late Night"]


def test_order_sizes(spark):
    got = column(spark, "int", [1, 2, 3, 4, 6, 7, 10, 11, None],
                 fn.classify(rules.ORDER_SIZES, "Extra Large", items=c("x")))
    assert got == ["Single Item", "Small", "Small", "Medium", "Medium", "Large", "Large", "Extra Large",
                   "Extra Large"]


@pytest.mark.parametrize(
    "recency, orders, spent, signup, segment",
    [(30, 10, 200, 999, "VIP"), (31, 10, 200, 999, "Loyal"), (90, 3, 10, 999, "Regular"),
     (91, 3, 50, 999, "At Risk"), (181, 3, 49, 999, "Churned"), (100, 3, 49, 999, "Occasional"),
     (None, None, None, 31, "Occasional"), (None, None, None, 30, "New"), (500, 2, 5, 999, "New")],
)
def test_segments(spark, recency, orders, spent, signup, segment):
    df = spark.createDataFrame([(recency, orders, spent, signup)], "r int, o int, s int, d int")
    got = df.select(fn.classify(rules.SEGMENTS, "Occasional", recency=c("r"), orders=c("o"), spent=c("s"),
                                signup=c("d"))).first()[0]
    assert got == segment


def test_churn_risk(spark):
    got = column(spark, "int", [7, 8, 30, 60, 90, 180, 181], fn.band(c("x"), "<=", rules.CHURN_RISK_MAX, 0.95))
    assert got == [0.0, 0.1, 0.1, 0.3, 0.6, 0.8, 0.95]


def test_location_keywords(spark):
    names = ["CENTRAL PARK", "DOWNTOWN PARK", "OFFICE ROW", "BUSINESS MILE", "STATE COLLEGE", "ELSEWHERE"]
    assert column(spark, "string", names, fn.keyword_class(c("x"), rules.LOCATION_TYPES, "Other")) == [
        "Park", "Park", "Business District", "Business District", "University", "Other"]
    assert column(spark, "string", names, fn.keyword_class(c("x"), rules.FOOT_TRAFFIC, "Low")) == [
        "Medium", "High", "Low", "Medium", "Low", "Low"]


def test_minutes_and_years_count_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2001, 1, 1, 10, 0, 59), datetime(2001, 1, 1, 10, 1, 1)),
         (datetime(2001, 1, 1, 10, 0, 0), datetime(2001, 1, 1, 10, 0, 59)),
         (datetime(2000, 12, 31, 23, 59, 0), datetime(2001, 1, 1, 0, 1, 0))],
        "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(fn.minutes_between(c("a"), c("b"))).collect()] == [1, 0, 2]
    years = spark.range(1).select(fn.years_between(F.lit(date(1990, 12, 31)), F.lit(date(1991, 1, 1))))
    assert years.first()[0] == 1


def test_minute_of_day(spark):
    values = [datetime(2001, 1, 1, 10, 11, 0), datetime(2001, 1, 1, 10, 11, 20),
              datetime(2001, 1, 1, 10, 11, 0, 5)]
    assert column(spark, "timestamp_ntz", values, fn.minute_of_day(c("x"))) == [611, None, None]
    assert column(spark, "timestamp_ntz", values, fn.minute_of_day(c("x"), "minute")) == [611, 611, 611]


def test_text(spark):
    mails = ["A@b.co", " a@b.co", "a@b", "bad@", None]
    assert column(spark, "string", mails, fn.clean_email(c("x"))) == ["a@b.co", None, None, None, None]
    assert column(spark, "string", ["+1 (555) 0-1"], fn.digits(c("x"))) == ["+155501"]
    assert column(spark, "string", [" ", "", " D1 ", None], fn.non_blank(c("x"))) == [None, None, "D1", None]
    df = spark.createDataFrame([(" ann ", None), (None, None), ("aNN", "o-neil smith")], "a string, b string")
    got = [r[0] for r in df.select(fn.full_name(c("a"), c("b"))).collect()]
    assert got == ["Ann", "", "Ann O-neil Smith"]


def test_guarded_arithmetic(spark):
    assert column(spark, "int", [0, -1, None, 1, 99, 100], fn.clamp(c("x"), 1, 99)) == [1, 1, 1, 1, 99, 99]
    assert column(spark, "int", [0, None, 4], fn.safe_pct(F.lit(1), c("x"))) == [0.0, 0.0, 25.0]
    margin = fn.safe_pct(F.lit(Decimal("2.45")), c("x"), places=8)
    assert column(spark, "decimal(4,2)", [Decimal("3.50")], margin) == [70.0]


def test_strict_and_lenient_cast(spark):
    with pytest.raises(PySparkException):
        column(spark, "string", ["abc"], fn.strict_cast(c("x"), "decimal(10,4)"))
    assert column(spark, "string", ["abc"], fn.strict_cast(c("x"), "decimal(10,4)", "null")) == [None]


def test_surrogate_key(spark):
    assert column(spark, "bigint", [1], fn.surrogate_key(c("x"))) == ["c4ca4238a0b923820dcc509a6f75849b"]
    one, two = column(spark, "bigint", [None, 1], fn.surrogate_key(c("x"), F.lit("a")))
    assert one and one != two


def test_peak_prefers_the_first_of_equals(spark):
    df = spark.createDataFrame([(2, 2, 1), (0, 0, 0), (0, 1, 3)], "b int, l int, d int")
    peak = fn.peak_of([("Breakfast", c("b")), ("Lunch", c("l")), ("Dinner", c("d"))])
    assert [r[0] for r in df.select(peak).collect()] == ["Breakfast", "Breakfast", "Dinner"]


def test_variant_flag(spark):
    docs = ['{"v":true}', '{"v":"true"}', '{"v":false}', '{"v":1}', "{}", None]
    assert column(spark, "string", docs, fn.variant_flag(F.parse_json("x"), "$.v")) == [
        True, True, False, False, False, False]
    assert column(spark, "string", ['{"v":12.6}', "{}"],
                  fn.variant_field(F.parse_json("x"), "$.v", "decimal(38,0)")) == [Decimal(13), None]


def test_distinct_list_and_mode(spark):
    df = spark.createDataFrame([("Side Dish",), ("Beverage",), ("Side Dish",), (None,)], "x string")
    assert df.agg(fn.distinct_list(c("x"))).first()[0] == "Beverage, Side Dish"
    assert df.where("x is null").agg(fn.distinct_list(c("x"))).first()[0] is None
    ties = spark.createDataFrame([(2,), (1,), (2,), (1,), (3,)], "x int")
    assert ties.agg(fn.det_mode(c("x")), fn.exact_median(c("x"))).first() == (1, 2.0)
