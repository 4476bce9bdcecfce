"""The ordered build: layers on disk, increments, gates; and the stream."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from layercake.operators import rank_by_pieces, read_upserted, settle
from layercake.plans import Run
from layercake.plans.build import MODELS, GateFailed, Layers, build, select
from layercake.plans.staging import stg_pos_order_headers
from layercake.sources import raw_tables
from layercake.streaming import file_stream, upsert_stream

c = F.col
CALENDAR = {"calendar_start": "1995-01-01", "calendar_end": "2002-01-01", "grain": "year"}


def plain(df):
    """Rows without audit times and documents, in a fixed order."""
    names = sorted(n for n in df.columns if n not in ("created_ts", "updated_ts", "health_metrics", "part"))
    return sorted(df.select(*names).collect(), key=str)


def test_selection_by_tags():
    assert select({"gold", "core"})[0] == "dim_country" and len(select({"gold", "core"})) == 9
    assert select({"silver", "intermediate"}) == [
        "int_orders_enriched", "int_menu_profitability", "int_customers_segmented"]
    assert select({"utils"}) == ["dim_date", "dim_time"]
    assert len(select(None)) == len(MODELS) == 26
    order = list(MODELS)
    for name, model in MODELS.items():
        assert all(order.index(i) < order.index(name) for i in model.inputs if i in MODELS)


def test_increments_in_order_equal_a_full_build(spark, tmp_path):
    raw = raw_tables(spark, SMALL)
    cut = F.lit(datetime(2000, 6, 1)).cast("timestamp_ntz")
    headers = settle(raw["order_header"], "h")
    ranked = settle(raw["order_detail"], "d")
    half = ranked.agg(F.expr("percentile(order_detail_id, 0.5)").cast("bigint")).first()[0]
    tags = {"silver", "staging"}
    first = {**raw, "order_header": headers.where(F.col("order_ts") <= cut),
             "order_detail": ranked.where(F.col("order_detail_id") <= half)}
    everything = {**raw, "order_header": headers, "order_detail": ranked}
    steps, whole = str(tmp_path / "steps"), str(tmp_path / "whole")
    early, late = (Run(date(2001, 8, 2), datetime(2001, 8, 2, h)) for h in (1, 2))
    build(spark, first, early, steps, tags, gates=False, **CALENDAR)
    stepped = build(spark, everything, late, steps, tags, gates=False, **CALENDAR)
    full = build(spark, everything, late, whole, tags, gates=False, **CALENDAR)
    for name in ("stg_pos_order_headers", "stg_pos_order_details"):
        assert plain(stepped[name]) == plain(full[name]), name
    old = stepped["stg_pos_order_headers"].where(F.col("updated_ts") < F.lit(late.loaded_at)).count()
    assert old == headers.where((F.col("order_ts") <= cut) & (F.col("order_total") > 0)).count()

    facts = build(spark, everything, late, steps, {"gold", "fact"}, gates=False, **CALENDAR)
    composed = Layers(spark, everything, late, "1995-01-01", "2002-01-01")
    assert plain(facts["fact_order"]) == plain(composed["fact_order"])
    assert plain(facts["fact_order_detail"]) == plain(composed["fact_order_detail"])
    again = build(spark, everything, late, steps, {"gold", "fact"}, gates=False, **CALENDAR)
    assert plain(again["fact_order"]) == plain(facts["fact_order"])


def test_a_gate_stops_the_build(spark, tmp_path):
    raw = raw_tables(spark, SMALL)
    run = Run(date(2001, 8, 2), datetime(2001, 8, 2))
    with pytest.raises(GateFailed, match="int_orders_enriched.line_item_count not_null"):
        build(spark, raw, run, str(tmp_path), {"silver", "intermediate"}, **CALENDAR)


def test_known_failures_pass_the_gate(spark, tmp_path):
    raw = raw_tables(spark, SMALL)
    run = Run(date(2001, 8, 2), datetime(2001, 8, 2))
    with pytest.raises(GateFailed) as stop:
        build(spark, raw, run, str(tmp_path / "a"), {"silver", "intermediate"}, **CALENDAR)
    found = [line.rsplit(":", 1)[0] for line in str(stop.value).split("failed: ")[1].split("; ")]
    known = [(*name.split(" ")[0].split(".", 1), name.split(" ")[1]) for name in found]
    built = build(spark, raw, run, str(tmp_path / "b"), {"silver", "intermediate"}, known_failures=known,
                  **CALENDAR)
    assert set(built) == {"int_orders_enriched", "int_menu_profitability", "int_customers_segmented"}


def test_dimension_keys_are_unique_so_facts_do_not_fan_out(spark):
    layers = Layers(spark, raw_tables(spark, SMALL), Run(date(2001, 8, 2)), "1995-01-01", "2002-01-01")
    for name, key in (("dim_truck", "truck_sk"), ("dim_location", "location_sk"), ("dim_menu_item", "menu_item_sk"),
                      ("dim_customer", "customer_sk")):
        assert layers[name].groupBy(key).count().where("count > 1").count() == 0
    assert layers["fact_order"].count() == layers["stg_pos_order_headers"].count()


def test_marts_count_repeated_orders_once(spark):
    run = Run(date(2001, 8, 2), datetime(2001, 8, 2))
    raw = dict(raw_tables(spark, SMALL))
    once = Layers(spark, dict(raw), run, "1995-01-01", "2002-01-01", write_shared=True)
    raw["order_header"] = raw["order_header"].unionByName(raw["order_header"].where(c("order_id") % 10 == 0))
    twice = Layers(spark, raw, run, "1995-01-01", "2002-01-01", write_shared=True)
    assert twice["fact_order"].count() > once["fact_order"].count()
    counts = ["total_orders", "mobile_orders", "breakfast_orders", "discounted_orders", "unique_customers"]
    key = ["sales_date", "truck_sk", "location_sk"]
    assert plain(twice["agg_daily_sales"].select(*key, *counts)) == plain(once["agg_daily_sales"].select(*key, *counts))
    orders = [m["agg_customer_360"].agg(F.sum("total_orders")).first()[0] for m in (once, twice)]
    assert orders[0] == orders[1] > 0


def test_composing_models_starts_no_job(spark):
    run = Run(date(2001, 8, 2), datetime(2001, 8, 2))
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    spark.sparkContext.setJobGroup("composing", "models that are composed")
    try:
        plans = [layers[name]._jdf.queryExecution().optimizedPlan().toString() for name in MODELS]
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("composing")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(plans) == len(MODELS) and not list(jobs)


def test_marts_rank_the_same_in_pieces(spark):
    run = Run(date(2001, 8, 2), datetime(2001, 8, 2))
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    sales = settle(layers["agg_daily_sales"], "sales")
    again = rank_by_pieces(sales, ["sales_date"], "total_revenue", "again", ["truck_sk", "location_sk"])
    assert again.where("again <> daily_revenue_rank").count() == 0 and again.count() == sales.count()


@pytest.mark.parametrize("mark", [None, ("order_ts", "order_timestamp")])
def test_stream_in_small_batches_equals_the_batch_model(spark, tmp_path, run, mark):
    raw = settle(raw_tables(spark, SMALL)["order_header"], "headers")
    arrivals = str(tmp_path / "arrivals")
    for year in (1995, 1998, 2000):
        later = {1995: 1998, 1998: 2000, 2000: 2100}[year]
        raw.where((F.year("order_ts") >= year) & (F.year("order_ts") < later)).coalesce(1).write.mode(
            "append").parquet(arrivals)
    stream = file_stream(spark, arrivals, raw.schema, files_per_batch=1)
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def clean(batch):
        df = stg_pos_order_headers(batch, run)
        return df if mark else df.withColumn("part", F.year("order_timestamp"))

    for _ in range(2):  # started again, it finds nothing new
        query = upsert_stream(stream, clean, target, "order_id", checkpoint,
                              partition_by=None if mark else "part", mark=mark)
        query.awaitTermination()
    assert plain(read_upserted(spark, target)) == plain(stg_pos_order_headers(raw, run))
