"""Readers, calendars, tables and names."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layercake.plans import calendar
from layercake.sources import (
    RAW_SCHEMAS,
    SOURCES,
    as_view,
    date_spine,
    freshness,
    layer_name,
    load_note,
    read_raw,
    source,
    table_exists,
    time_spine,
    write_table,
)


def test_every_declared_source_has_a_schema():
    assert set(RAW_SCHEMAS) == set(SOURCES) and len(RAW_SCHEMAS) == 8


def test_read_raw_takes_a_folder_tree_in_the_declared_schema(spark, tmp_path):
    for part, line in (("a", '1,1,Ice,Brand,10,Cone,Dessert,Cold,1.5,3.25,"{""calories"":120}"\n'),
                       ("b", "2,1,Ice,Brand,11,Cup,Dessert,Cold,,2,\n")):
        (tmp_path / part).mkdir()
        (tmp_path / part / "data.csv").write_text(line)
    menu = read_raw(spark, "menu", str(tmp_path)).orderBy("menu_item_id")
    assert menu.schema["menu_item_health_metrics_obj"].dataType.typeName() == "variant"
    got = menu.select("menu_item_name", "cost_of_goods_usd",
                      F.variant_get("menu_item_health_metrics_obj", "$.calories", "int")).collect()
    assert [tuple(map(str, r)) for r in got] == [("Cone", "1.5000", "120"), ("Cup", "None", "None")]


def test_read_raw_fails_on_a_bad_row(spark, tmp_path):
    (tmp_path / "x.csv").write_text("one,US\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw(spark, "country", str(tmp_path)).collect()


def test_source_by_name(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "raw_pos" / "truck"))
    assert source(spark, "raw_pos", "truck", str(tmp_path)).count() == 3
    with pytest.raises(KeyError):
        source(spark, "raw_pos", "customer_loyalty", str(tmp_path))


@pytest.mark.parametrize("hours, status", [(6, "pass"), (7, "warn"), (12, "warn"), (13, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(datetime(2001, 1, 1),)], "ts timestamp_ntz")
    as_of = F.lit(datetime(2001, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(hours))
    assert freshness(df, "ts", 6, 12, as_of).first()["status"] == status
    assert freshness(df.where("false"), "ts", 6, 12, as_of).first()["status"] == "error"


def test_spines(spark):
    days = date_spine(spark, "2020-01-01", "2030-12-31")
    first_last = days.agg(F.count("*"), F.min("date_day"), F.max("date_day")).first()
    assert [str(v) for v in first_last] == ["4017", "2020-01-01", "2030-12-30"]
    assert time_spine(spark).count() == 1440
    with pytest.raises(ValueError):
        date_spine(spark, "1000-01-01", "9000-01-01")


def test_dim_date_rows(spark):
    rows = {str(r["date_actual"]): r for r in calendar.dim_date(spark).where(
        "date_actual in ('2020-01-01', '2020-03-31', '2020-04-01', '2023-01-01')").collect()}
    first = rows["2020-01-01"]
    assert (first["date_sk"], first["holiday_name"], first["fiscal_year"], first["fiscal_quarter"],
            first["fiscal_month"]) == (20200101, "New Year's Day", 2019, 4, 10)
    assert [rows["2020-03-31"][k] for k in ("fiscal_year", "fiscal_quarter", "fiscal_month")] == [2019, 4, 12]
    assert [rows["2020-04-01"][k] for k in ("fiscal_year", "fiscal_quarter", "fiscal_month")] == [2020, 1, 1]
    sunday = rows["2023-01-01"]
    assert sunday["day_of_week"] == 0 and sunday["is_weekend"] and sunday["day_of_week_name"] == "Sunday"


def test_dim_time_rows(spark):
    rows = {r["hour_minute"]: r for r in calendar.dim_time(spark).collect()}
    assert [(rows[t]["hour_12"], rows[t]["am_pm"]) for t in ("00:00", "12:00", "23:59")] == [
        (12, "AM"), (12, "PM"), (11, "PM")]
    assert rows["23:59"]["time_sk"] == 2359 and len(rows) == 1440


def test_views_tables_and_names(spark, tmp_path):
    as_view(spark.range(2), "two")
    assert spark.table("two").count() == 2
    assert layer_name(None, "base") == "base" and layer_name(" gold ", "base") == "gold"
    path = str(tmp_path / "t")
    assert write_table(spark.range(4), path).count() == 4
    assert write_table(spark.range(5), path).count() == 5
    assert not table_exists(spark, "default", "nowhere")
    assert load_note(spark, "done").first()["note"] == "done"


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, capsys):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS lc_test LOCATION '{tmp_path}'")
    try:
        for name in ("left_side", "right_side"):
            write_table(spark.range(100).withColumn("v", F.col("id")), f"lc_test.{name}", bucket_by=["id"],
                        buckets=4)
        assert table_exists(spark, "lc_test", "left_side")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("lc_test.left_side").join(spark.table("lc_test.right_side"), "id")
        joined.groupBy("id").count().explain()
        assert "Exchange hashpartitioning" not in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.sql("DROP SCHEMA lc_test CASCADE")
