"""Tables: loads with bad rows, marks from footers, catalog, buckets, gates while writing, marts by increments."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from layercake import operators as ops
from layercake.operators.incremental import high_water_mark, new_rows
from layercake.plans import Run
from layercake.plans.build import Layers, build
from layercake.plans.increments import first_changed_day, refresh_mart
from layercake.quality.catalogue import RULES
from layercake.quality.checks import Rule, Watched, check
from layercake.sources import catalog, footers, raw_tables, readers
from layercake.sources.sinks import catalog_view

c = F.col
CALENDAR = {"calendar_start": "1995-01-01", "calendar_end": "2002-01-01", "grain": "year"}


def executed(df):
    """The plan that has run, without what adaptive execution started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def text_file(folder, name, *lines):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(lines) + "\n")


# Loads

GOOD = ["1,Ann,Lee,Rome,Italy,a@b.it,+39 1", "2,Bo,,,,,"]


def test_bad_rows_are_kept_with_their_files(spark, tmp_path):
    text_file(tmp_path / "x", "one.csv", *GOOD, "three,Cy,,,,,")
    text_file(tmp_path / "x" / "deep", "two.csv", "4,only")
    good, bad = readers.load_raw(spark, "franchise", str(tmp_path / "x"), most_bad=2)
    assert sorted(r.franchise_id for r in good.collect()) == [1, 2] and good.schema == readers.RAW_SCHEMAS["franchise"]
    assert sorted((r.file.rsplit("/", 1)[1], r.row) for r in bad.collect()) == [("one.csv", "three,Cy,,,,,"), ("two.csv", "4,only")]
    with pytest.raises(readers.BadRows, match="2 rows do not fit franchise.*(4,only|three,Cy)"):
        readers.load_raw(spark, "franchise", str(tmp_path / "x"), most_bad=1)


def test_a_document_that_does_not_parse_makes_a_bad_row(spark, tmp_path):
    row = '1,2,Ice,Brand,{},Cone,Dessert,Cold,1.5,3.0,"{}"'
    text_file(tmp_path, "m.csv", row.format(7, '{""calories"":5}'), row.format(8, "{broken"), row.format(9, ""))
    good, bad = readers.load_raw(spark, "menu", str(tmp_path), most_bad=1)
    assert sorted(r.menu_item_id for r in good.collect()) == [7, 9]
    assert "{broken" in bad.first().row and good.schema["menu_item_health_metrics_obj"].dataType.simpleString() == "variant"


def test_no_rows_and_no_bad_rows(spark, tmp_path):
    text_file(tmp_path, "f.csv", *GOOD)
    good, bad = readers.load_raw(spark, "franchise", str(tmp_path))
    assert good.count() == 2 and bad.count() == 0
    (tmp_path / "f.csv").write_text("")
    good, bad = readers.load_raw(spark, "franchise", str(tmp_path))
    assert good.count() == 0 and bad.count() == 0


# Marks


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    start = F.lit("2024-02-28 23:59:00")
    spark.range(500).select(
        "id", (c("id") % 7).cast("int").alias("small"), F.timestamp_seconds(F.unix_timestamp(start) + c("id") * 61).alias("at"),
        F.timestamp_seconds(F.unix_timestamp(start) + c("id") * 61).cast("timestamp_ntz").alias("local_at"),
        F.date_add(F.lit(date(2024, 1, 1)), c("id").cast("int")).alias("day"), c("id").cast("string").alias("name"),
        (c("id") / 3).alias("ratio"),
    ).repartition(3).write.parquet(path)
    return path


@pytest.mark.parametrize("column", ["id", "small", "at", "local_at", "day", "name", "ratio"])
def test_marks_come_from_the_footers(spark, stored, column):
    df = spark.read.parquet(stored)
    assert high_water_mark(df, column, stored=True) == high_water_mark(df, column)
    pushed = f"MAX({column})" in footers.footer_extremes(df, column)._jdf.queryExecution().executedPlan().toString()
    assert pushed == (column != "name")


def test_marks_of_old_times_are_read(spark, stored, tmp_path):
    old, spark_ = str(tmp_path / "old"), spark
    spark_.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark_.read.parquet(stored).write.parquet(old)
    finally:
        spark_.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    df = spark_.read.parquet(old)
    assert high_water_mark(df, "at", stored=True) == high_water_mark(df, "at")


def test_marks_where_a_file_has_nothing_but_null(spark, tmp_path):
    for v in (None, 4):
        spark.createDataFrame([(1, v)], "k int, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    assert high_water_mark(spark.read.parquet(str(tmp_path / "t")), "v", stored=True) == 4


def test_freshness_and_new_rows_of_stored_tables(spark, stored):
    df, now = spark.read.parquet(stored), datetime(2024, 2, 29, 9)
    read, told = (readers.freshness(df, "local_at", 2, 4, F.lit(now), stored=s).collect() for s in (False, True))
    assert read == told
    source = spark.range(490, 510).select("id")
    assert [r.id for r in new_rows(source, df, "id", "id", stored=True).orderBy("id").collect()] == list(range(500, 510))
    empty = df.where("id < 0")
    assert high_water_mark(empty, "id") is None


def test_an_empty_stored_table_has_no_mark(spark, tmp_path):
    ops.replace_table(spark.createDataFrame([], "k int, at timestamp_ntz"), str(tmp_path / "t"))
    table = ops.read_upserted(spark, str(tmp_path / "t"))
    assert [high_water_mark(table, name, stored=True) for name in ("k", "at")] == [None, None]


def test_files_with_other_columns_are_known_as_mixed(spark, tmp_path):
    path = str(tmp_path / "t")
    ops.upsert_table(spark.createDataFrame([(1, 5, 1)], "k int, v int, p int"), path, "k", "sync", "p")
    assert not catalog.newest(spark, path).mixed
    ops.upsert_table(spark.createDataFrame([(9, 2, 2)], "v int, k int, p int"), path, "k", "sync", "p")
    assert catalog.newest(spark, path).mixed
    assert sorted(map(tuple, ops.read_upserted(spark, path).select("k", "v").collect())) == [(1, 5), (2, 9)]


# Catalog


def test_a_view_of_the_catalog_is_read_by_another_session(spark, tmp_path):
    spark.range(10).write.option("path", str(tmp_path / "ten")).saveAsTable("ten_numbers")
    catalog_view(spark, "layercake_test.even_numbers", "SELECT id FROM ten_numbers WHERE id % 2 = 0")
    other = spark.newSession()
    assert other.table("layercake_test.even_numbers").count() == 5
    catalog_view(other, "layercake_test.even_numbers", "SELECT id FROM ten_numbers WHERE id % 5 = 0")
    assert spark.table("layercake_test.even_numbers").count() == 2


def test_bucketed_tables_join_without_shuffles(spark, tmp_path):
    buckets = catalog.Buckets(("k",), 4)
    numbers = spark.range(2000).select(c("id").alias("k"), (c("id") % 3).alias("p"))
    for name, rows in (("a", numbers), ("b", numbers.withColumn("v", c("k") * 2))):
        ops.upsert_table(rows, str(tmp_path / name), "k", partition_by="p", buckets=buckets)
        ops.upsert_table(rows.where("k < 10"), str(tmp_path / name), "k", partition_by="p")
    a, b = (ops.read_upserted(spark, str(tmp_path / name)) for name in "ab")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b.select("k", "v"), "k")
        assert "Exchange" not in executed(joined) and joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_built_in_buckets_meet_without_shuffles(spark, tmp_path, run):
    raw, base = raw_tables(spark, SMALL), str(tmp_path)
    build(spark, raw, run, base, {"silver", "staging", "orders"}, gates=False, buckets=3, **CALENDAR)
    built = build(spark, raw, run, base, {"gold", "fact"}, gates=False, buckets=3, **CALENDAR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        heads = built["fact_order"].select("order_sk", "order_total")
        joined = built["fact_order_detail"].select("order_sk", "line_total").join(heads, "order_sk")
        assert "Exchange" not in executed(joined)
        lines = ops.read_upserted(spark, f"{base}/silver/stg_pos_order_details")
        ids = ops.read_upserted(spark, f"{base}/silver/stg_pos_order_headers").select("order_id")
        assert "Exchange" not in executed(lines.join(ids, "order_id", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_over_bucketed_tables_are_right(spark, tmp_path):
    names = [f"bucketed_{i}" for i in range(3)]
    for i, name in enumerate(names):
        rows = spark.range(500).select(c("id").alias("k"), F.lit(i).alias("v"))
        rows.write.option("path", str(tmp_path / name)).format("parquet").bucketBy(4, "k").sortBy("k").saveAsTable(name)
    a, b, d = (spark.table(name) for name in names)
    sums = a.unionByName(b).unionByName(d).groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    assert sums.count() == 500 and sums.where("v <> 3 OR n <> 3").count() == 0


# Gates


def test_row_level_rules_are_counted_by_the_write(spark, tmp_path):
    rules = [Rule("v", "not_null"), Rule("v", "accepted_range", low=0, where="k > 1"), Rule("k", "unique"),
             Rule("even", "expression_is_true", expression="v % 2 = 0", severity="warn")]
    df = spark.createDataFrame([(1, -1), (2, -1), (2, None), (3, 4)], "k int, v int")
    watched = Watched("m", rules)
    watched.watch(df).write.parquet(str(tmp_path / "t"))
    seen = {(r.column, r.test): (r.severity, r.failures) for r in watched.results(spark).collect()}
    read = {(r.column, r.test): (r.severity, r.failures) for r in check(df, "m", rules).collect()}
    assert seen == {key: value for key, value in read.items() if key[1] != "unique"} and read[("k", "unique")] == ("error", 1)
    assert seen[("v", "accepted_range")] == ("error", 1) and seen[("even", "expression_is_true")] == ("warn", 2)


def test_a_gated_build_does_not_test_rows_in_passes_of_their_own(spark, tmp_path, run, monkeypatch):
    from layercake.quality import checks

    passes = []
    plain = checks._row_level
    monkeypatch.setattr(checks, "_row_level", lambda df, model, rules: passes.append(model) or plain(df, model, rules))
    raw = raw_tables(spark, SMALL)
    known = [("stg_pos_order_details", "order_id", "relationships")]
    build(spark, raw, run, str(tmp_path), {"silver", "staging", "orders"}, known_failures=known, **CALENDAR)
    assert not passes and {"stg_pos_order_headers", "stg_pos_order_details"} <= set(RULES)


def test_unique_rules_of_a_table_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "b", -0.0), (None, "b", 2.0), (None, None, 3.0)], "k int, s string, d double")
    rules = [Rule("k", "unique"), Rule("s", "unique"), Rule("d", "unique"), Rule("s", "unique", where="k IS NOT NULL")]
    found = check(df, "m", rules)
    assert [(r.column, r.failures) for r in found.collect()] == [("k", 1), ("s", 1), ("d", 1), ("s", 0)]
    assert executed(found).count("Exchange hashpartitioning") == 1
    assert check(df.where("false"), "m", rules).agg(F.sum("failures")).first()[0] == 0


def test_marts_of_orders_that_do_not_repeat_look_for_no_repeats(spark):
    from layercake.operators.counts import keys_repeat
    from layercake.plans.analytics import daily_sales_totals
    from layercake.plans.operator_queries import layers, mart_layers

    assert keys_repeat(spark.createDataFrame([(1,), (None,), (None,), (1,)], "k int"), "k")
    assert not keys_repeat(spark.createDataFrame([(1,), (None,), (None,), (2,)], "k int"), "k")
    known, unknown = mart_layers(spark, SMALL), layers(spark, SMALL)
    assert known.run.unique_orders and not unknown.run.unique_orders
    plans = [daily_sales_totals(of["fact_order"].limit(10**6), of.run)._jdf.queryExecution().optimizedPlan().toString()
             for of in (known, unknown)]
    assert ["Window [" in plan.split("Limit")[0] for plan in plans] == [False, True]


# Members, listings, increments


def test_bitmaps_merge_exactly(spark):
    rows = spark.range(3000).select((c("id") * 37 % 700).alias("m"), (c("id") % 10).alias("day")).unionByName(
        spark.createDataFrame([(None, 3), (None, 11)], "m long, day long"))
    numbered = rows.join(ops.number_members(rows, "m"), "m", "left")
    days = ops.member_bitmaps(numbered, ["day"], "number")
    halves = ops.merge_bitmaps(days.withColumn("half", (c("day") / 5).cast("int")), ["half"])
    for by, parts, key in ((["day"], days, c("day")), (["half"], halves, (c("day") / 5).cast("int"))):
        got = {r[0]: r[1] for r in ops.count_members(parts, by, "n").collect()}
        want = {r[0]: r[1] for r in rows.where("m IS NOT NULL").groupBy(key.alias("g")).agg(F.countDistinct("m")).collect()}
        assert got == want
    # Loads add up: the members of two loads are those of both together.
    again = ops.count_members(ops.merge_bitmaps(days.unionByName(days), ["day"]), ["day"], "n")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in ops.count_members(days, ["day"], "n").collect()}


def test_listings_come_in_order(spark):
    from layercake.plans.table_queries import ordered_feeds, ordered_tasks

    feeds = [(r.loaded_at, r.feed_name) for r in ordered_feeds(spark, SMALL).collect()]
    assert len(feeds) > 100 and feeds == sorted(feeds, key=lambda x: (-x[0].timestamp(), x[1]))
    tasks = [(r.feed_name, r["index"]) for r in ordered_tasks(spark, SMALL).collect()]
    assert len(tasks) > 300 and tasks == sorted(tasks)


def test_increments_leave_earlier_months_alone(spark, tmp_path, run):
    raw = dict(raw_tables(spark, SMALL))
    headers, target = raw["order_header"], str(tmp_path / "mart")
    cut = datetime(2000, 3, 10)
    early = {**raw, "order_header": headers.where(c("order_ts") < F.lit(cut).cast("timestamp_ntz"))}
    calendar = ("1995-01-01", "2002-01-01")
    refresh_mart(Layers(spark, early, run, *calendar), "agg_daily_sales", target)
    before = set(ops.read_upserted(spark, f"{target}/totals").inputFiles())
    whole = Layers(spark, raw, Run(run.as_of, run.loaded_at + timedelta(hours=1)), *calendar)
    came = whole["fact_order"].where(c("order_timestamp") >= F.lit(cut).cast("timestamp_ntz"))
    since = first_changed_day(came)
    got = refresh_mart(whole, "agg_daily_sales", target, since)
    after = set(ops.read_upserted(spark, f"{target}/totals").inputFiles())
    old_months = {f for f in before if any(f"_folder=v-{y}" in f for y in range(1995, 2000))}
    assert since >= date(2000, 3, 10) and old_months and old_months <= after and not before <= after
    names = sorted(n for n in got.columns if not n.endswith("_ts"))
    assert sorted(got.select(names).collect(), key=str) == sorted(whole["agg_daily_sales"].select(names).collect(), key=str)
    assert first_changed_day(came.where("false")) is None


def test_facts_are_cut_at_the_exact_median_of_their_ids(spark):
    from layercake.plans.table_queries import buckets_for, middle_id

    for ids in ([5, 1, 9], [4, 1, 9, 7], [2, 2, 8, None], [3]):
        lines = spark.createDataFrame([(i,) for i in ids], "order_detail_id bigint")
        want = lines.agg(F.expr("percentile(order_detail_id, 0.5)").cast("bigint")).first()[0]
        assert middle_id(lines) == want
    assert middle_id(lines.where("false")) is None
    assert [buckets_for(n) for n in (0, 8_000_000, 8_000_001, 36_000_000)] == [4, 4, 5, 18]


def test_unique_rules_hold_no_map_of_values(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    found = check(df, "m", [Rule("k", "unique")])
    assert [r.failures for r in found.collect()] == [1]
    assert "keys=[rule" not in executed(found) and executed(found).count("WindowGroupLimit") == 2


def test_a_session_reads_no_more_than_the_limits_per_task(spark):
    from layercake.session import AT_MOST, _bytes, prepare

    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    other.conf.set("spark.sql.shuffle.partitions", "5000")
    prepare(other)
    assert {key: _bytes(other.conf.get(key)) for key in AT_MOST} == {
        "spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 10
    }
    assert other.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "5000"


def test_menu_totals_shuffle_lines_once_after_their_orders(spark, run):
    from layercake.plans.analytics import menu_totals

    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    facts = [layers["order_lines"], layers["fact_order"], layers["dim_truck"]]
    totals = menu_totals(*facts, run)
    plan = executed(totals)
    assert "Expand" not in plan and "hashpartitioning(order_sk" not in plan
    # By id and by surrogate key the facts meet in the same rows.
    by_key = menu_totals(layers["fact_order_detail"], *facts[1:], run)
    assert sorted(map(str, totals.collect())) == sorted(map(str, by_key.collect()))


def test_keys_are_packed_and_unpacked(spark):
    from layercake import functions as fn

    rows = spark.createDataFrame([("1",), ("-1",), (None,), ("x" * 32,)], "k string")
    keys = rows.select("k").union(rows.select(fn.surrogate_key(c("k"))))
    packed = keys.select("k", fn.packed_key(c("k")).alias("p"))
    assert packed.where(~fn.unpacked_key(c("p")).eqNullSafe(c("k"))).isEmpty()
    assert packed.agg(F.min(F.length("p")), F.max(F.length("p"))).first() == (1, 32)


def test_sales_are_not_added_up_for_readers_of_item_names(spark, run):
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    assert "l_orderkey" not in executed(layers["dim_menu_item"].select("menu_item_sk", "item_category"))


def test_marts_by_increments_settle_only_what_their_totals_take(spark, run):
    from layercake.plans.increments import GROWING

    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    assert "l_orderkey" not in executed(layers["fact_order"].select(*GROWING["agg_location_insights"].columns))


def test_the_suite_of_the_marts_computes_what_it_shares_once(spark, monkeypatch):
    from layercake.plans import build, operator_queries

    written = []

    def note(df, name):
        written.append((name, set(df.columns)))
        return df

    monkeypatch.setattr(build, "settle", note)
    monkeypatch.setattr(operator_queries.ops, "settle", note)
    monkeypatch.setattr(operator_queries, "check_models", lambda built, names: built)
    built = operator_queries.dq_marts(spark, SMALL)
    names, columns = [name for name, _ in written], dict(written)
    assert len(names) == len(set(names)) and names.index("int_orders_enriched") < names.index("dim_customer")
    # Of what only feeds the marts nothing else is written; the marts themselves are whole.
    assert "categories_ordered" not in columns["int_orders_enriched"] and "order_sk" not in columns["fact_order"]
    assert "order_detail_sk" not in columns["fact_order_detail"] and "order_detail_id" not in columns["stg_pos_order_details"]
    assert columns["agg_menu_performance"] >= {"category_popularity_rank", "performance_classification"}
    assert built.run.unique_orders


def test_places_and_trucks_of_customers_are_counted_without_more_rows(spark, run):
    from layercake.plans.analytics import _transactions, location_totals

    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    orders = layers["fact_order"]
    history = _transactions(orders, layers["dim_date"], layers["dim_truck"], layers["dim_location"], run)
    totals = location_totals(orders, run)
    assert "Expand" not in executed(history) and "Expand" not in executed(totals)
    want = orders.where("customer_sk <> '-1'").groupBy("customer_sk").agg(
        F.countDistinct("location_sk"), F.countDistinct("truck_sk"), F.countDistinct("order_id"))
    got = history.select("customer_sk", "unique_locations_visited", "unique_trucks_visited", "total_orders")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    want = orders.where("location_sk <> '-1'").groupBy("location_sk", "order_date_sk").agg(
        F.countDistinct("truck_sk"), F.countDistinct("customer_sk"))
    got = totals.select("location_sk", "order_date_sk", "trucks_served", "unique_customers")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_order_lines_meet_their_orders_last(spark, run):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
        buyers = layers["fact_order"].select("order_id", "customer_sk")
        plan = executed(layers["order_lines"].join(buyers, "order_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The lines are shuffled by their items and then once by their orders; the other shuffle by orders is that of the buyers.
    assert plan.count("Exchange hashpartitioning(menu_item_id") == 1
    assert plan.count("Exchange hashpartitioning(order_id") == 2


def test_what_the_customer_mart_writes_apart_is_for_it_alone(spark, run):
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01", write_shared=True)
    mart = layers["agg_customer_360"]
    plan = executed(mart)
    assert "categories_ordered" not in plan and "l_orderkey" in plan
    assert layers["fact_order"].where("order_sk IS NULL OR order_time_sk IS NULL").isEmpty()
    assert layers["fact_order"].where("categories_ordered IS NOT NULL").count() > 0


# What a job holds on disk

def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (held.apply(n).getName() for n in range(held.size())) if name.startswith("shuffle_")}


def written_apart(monkeypatch):
    """The names and columns of what models write apart, which is not written then."""
    from layercake.plans import build

    written = {}

    def note(df, name):
        written[name] = set(df.columns)
        return df

    monkeypatch.setattr(build, "settle", note)
    return written


def test_shuffles_go_with_the_statement_that_made_them(spark, tmp_path):
    before = shuffle_files(spark)
    dealt = spark.range(1000).repartition(3, "id")
    kept = ops.settle(dealt, "dealt")
    ops.upsert_table(dealt.withColumn("v", c("id")), str(tmp_path / "t"), "id")
    assert kept.count() == ops.read_upserted(spark, str(tmp_path / "t")).count() == 1000
    assert shuffle_files(spark) <= before
    # Rows that are asked for again are made again.
    assert len(dealt.collect()) == len(dealt.collect()) == 1000


def test_what_is_written_between_steps_is_packed_tightly(spark, tmp_path):
    rows = spark.range(5).withColumn("p", c("id") % 2)
    ops.upsert_table(rows, str(tmp_path / "t"), "id", partition_by="p")
    for table in (ops.settle(rows, "rows"), ops.read_upserted(spark, str(tmp_path / "t"))):
        assert table.count() == 5 and all(".zstd." in file for file in table.inputFiles())


def test_surrogate_keys_travel_packed_into_buckets(spark, tmp_path):
    from layercake import functions as fn

    rows = spark.range(40).select("id", fn.surrogate_key(c("id")).alias("a_sk"), F.when(c("id") > 30, "-1").when(
        c("id") > 5, fn.surrogate_key(c("id") + 1)).alias("b_sk"), F.lit("X" * 32).alias("text"))
    want = sorted(map(tuple, rows.collect()))
    path, dealt = str(tmp_path / "t"), catalog.Buckets(("a_sk",), 4)
    ops.upsert_table(rows.where("id < 20"), path, "id", buckets=dealt, keys=["a_sk", "b_sk"])
    ops.upsert_table(rows.where("id >= 10"), path, "id", keys=["a_sk", "b_sk"])
    table = ops.read_upserted(spark, path)
    assert sorted(map(tuple, table.collect())) == want and table.columns == rows.columns
    # Each bucket is written by one task, as the keys were dealt by what they are and not by how they travel.
    assert len(table.inputFiles()) == 4 and table.where(c("a_sk") == want[7][1]).count() == 1
    joined = table.join(table.select("a_sk", c("id").alias("other")), "a_sk")
    assert joined.count() == 40 and joined.where("id = other").count() == 40


def test_lines_are_numbered_only_for_readers_of_their_ids(spark, tmp_path):
    schema = ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double")
    lines = [(1, 7, 1, 2.0, 0.0), (1, 7, 1, 2.0, 0.0), (1, 8, 2, 1.0, 0.1), (None, 7, 1, 3.0, 0.0), (2, 9, 1, 4.0, 0.0)]
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, 3), (8, None)], "p_partkey bigint, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    details = raw_tables(spark, str(tmp_path))["order_detail"]
    ids = sorted(r[0] or 0 for r in details.select("order_detail_id").collect())
    assert ids == [0, 1001, 1002, 1003, 2001] and details.schema["order_detail_id"].dataType.simpleString() == "bigint"
    there = details.where(c("order_detail_id").isNotNull()).select("order_id", "quantity")
    assert "Window" not in executed(there) and there.count() == 4
    assert "Window" in executed(details.select("order_detail_id"))


def test_marts_take_members_by_id_and_by_key_alike(spark, run):
    from layercake import functions as fn
    from layercake.plans.analytics import customer_tastes, menu_item_totals, menu_totals

    keyed = spark.createDataFrame(
        [(1, 20000101, 1, 5, "Web"), (2, 20000101, 1, None, "Walk-up"), (3, 20000101, 1, None, None), (4, 20000102, 9, 6, "Web"),
         (5, 20000101, 1, 5, "Mobile App")],
        "order_id bigint, order_date_sk int, truck bigint, customer_id bigint, order_channel string",
    ).select("*", fn.surrogate_key(c("order_id")).alias("order_sk"), fn.member_key(c("customer_id")).alias("customer_sk"),
             fn.surrogate_key(c("truck")).alias("truck_sk"), F.lit("Lunch").alias("meal_period"))
    sold = spark.createDataFrame(
        [(1, 7), (1, 7), (2, 7), (3, 7), (5, 7), (5, None), (4, 7), (8, 7), (1, 3)], "order_id bigint, menu_item_id bigint")
    money = [F.lit(n).cast("decimal(18,4)").alias(name) for n, name in enumerate(
        ("line_total", "line_cost_of_goods", "line_profit", "unit_price", "line_discount_amount"), 1)]
    sold = sold.select("*", F.when(c("order_id") != 8, fn.surrogate_key(c("order_id"))).otherwise("-1").alias("order_sk"),
                       fn.member_key(c("menu_item_id")).alias("menu_item_sk"), F.lit(2).alias("quantity"), *money)
    trucks = keyed.where("truck = 1").select("truck_sk", c("truck").alias("truck_id")).distinct()
    by_id = menu_totals(sold, keyed, trucks, run)
    by_key = menu_totals(sold.drop("menu_item_id"), keyed.drop("customer_id"), trucks, run)
    assert by_id.columns == by_key.columns and sorted(map(str, by_id.collect())) == sorted(map(str, by_key.collect()))
    item = menu_item_totals(sold, keyed, trucks, run).where("menu_item_id = 7").collect()
    # Two orders of unknown customers count as one customer; the truck of the second day is unknown.
    assert [(r.order_date_sk, r.unique_customers, r.orders_containing_item, r.total_quantity_sold, r.walkin_quantity, r.mobile_quantity)
            for r in item] == [(20000101, 2, 4, 10, 2, 2)]
    items = sold.where("menu_item_id IS NOT NULL").select("menu_item_id", "menu_item_sk").distinct().selectExpr(
        "*", "'c' AS item_category", "'s' AS item_subcategory", "'b' AS truck_brand_name", "true AS is_vegetarian",
        "false AS is_vegan", "false AS is_gluten_free")
    tastes = [customer_tastes(o, d, items) for o, d in ((keyed, sold), (keyed.drop("customer_id"), sold.drop("menu_item_id")))]
    assert sorted(map(str, tastes[0].collect())) == sorted(map(str, tastes[1].collect())) and tastes[0].count() == 2


def test_lines_of_marts_move_with_ids(spark, run):
    from layercake.plans.analytics import menu_item_totals

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
        plan = executed(menu_item_totals(layers["order_lines"], layers["order_heads"], layers["dim_truck"], run))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Neither line numbers nor keys of items and customers are made; lines move by parts, orders and (day, item).
    assert "l_linenumber" not in plan and "unhex(menu_item_sk" not in plan and "unhex(customer_sk" not in plan
    assert plan.count("Exchange hashpartitioning(pk") == 2


def test_steps_of_marts_are_written_apart(spark, run, monkeypatch):
    written = written_apart(monkeypatch)
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01", write_shared=True)
    for name in ("agg_menu_performance", "agg_customer_360"):
        layers.compose(name)
    assert set(written) == {"menu_totals", "menu_items", "int_orders_enriched", "order_heads", "history"}
    assert "customer_id" in written["order_heads"] and "customer_sk" not in written["order_heads"]
    assert "menu_item_id" in written["menu_totals"] and "menu_item_sk" not in written["menu_totals"]


def test_totals_kept_by_other_keys_are_added_up_anew(spark, tmp_path, run):
    from layercake.plans.analytics import menu_totals
    from layercake.plans.increments import totals_target

    target = str(tmp_path / "mart")
    layers = Layers(spark, raw_tables(spark, SMALL), run, "1995-01-01", "2002-01-01")
    by_key = menu_totals(layers["order_lines"], layers["order_heads"], layers["dim_truck"], run)
    part = F.floor(c("order_date_sk") / 100).cast("int").alias("_part")
    ops.replace_table(by_key.where("order_date_sk < 20000101").select("*", part), totals_target(target), "_part")
    got = refresh_mart(layers, "agg_menu_performance", target, date(2000, 1, 1))
    assert got.count() == layers["agg_menu_performance"].count() > 0
    assert got.agg(F.sum("total_revenue")).first() == layers["agg_menu_performance"].agg(F.sum("total_revenue")).first()
