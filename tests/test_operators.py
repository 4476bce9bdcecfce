"""Operators on small fixtures, against plain Python where the answer is not obvious."""

import json
import uuid
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from layercake import operators as ops
from layercake.operators import windows

c = F.col


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keep_latest_is_one_row_per_key_and_repeatable(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, 1, "x")], "k int, t int, v string")
    for parts in (1, 5):
        got = rows(ops.keep_latest(df.repartition(parts), ["k"], [c("t").desc()]), "k")
        assert got == [(1, 5, "a"), (2, 1, "x")]


def test_keep_latest_limits_rows_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((c("id") % 3).alias("k"), "id")
    ops.keep_latest(df, ["k"], [c("id").desc()]).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


def test_left_join_keeps_rows_that_may_not_match(spark):
    trucks = spark.createDataFrame([(1, 7, True), (2, 7, False), (3, None, True)], "t int, f int, own boolean")
    owners = spark.createDataFrame([(7, "k7")], "f int, sk string")
    got = rows(ops.left_join_where_left(trucks, owners, "f", c("own")).select("t", "f", "sk"), "t")
    assert got == [(1, 7, "k7"), (2, 7, None), (3, None, None)]


@pytest.mark.parametrize("options", [{}, {"spread_by": "id"}])
def test_lookup_key_unknown_member(spark, options):
    facts = spark.createDataFrame([(1, 25.0), (2, 3.0), (3, None)], "id int, loc double")
    dim = spark.createDataFrame([(3, "k3")], "location_id bigint, location_sk string")
    got = ops.lookup_key(facts, dim, c("loc"), c("location_id").cast("double"), "location_sk", "-1", **options)
    assert rows(got.select("id", "location_sk"), "id") == [(1, "-1"), (2, "k3"), (3, "-1")]


def test_null_keys_are_spread_over_partitions(spark):
    facts = spark.range(4000).select("id", F.lit(None).cast("bigint").alias("k"))
    dim = spark.range(10).select(c("id").alias("k2"), c("id").cast("string").alias("sk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = ops.lookup_key(facts, dim, c("k"), c("k2"), "sk", "-1", spread_by="id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2000


def test_conditional_counts_equal_distinct_counts(spark):
    random.seed(1)
    data = [(random.randrange(3), random.choice([None, *range(20)]), random.randrange(4)) for _ in range(300)]
    df = spark.createDataFrame(data, "g int, k int, v int")
    conditions = {"all_keys": None, "zero": c("v") == 0, "high": c("v") > 1}
    got = ops.conditional_counts(df, ["g"], "k", conditions, {"total": c("v")})
    want = df.groupBy("g").agg(
        F.countDistinct("k").alias("all_keys"),
        F.countDistinct(F.when(c("v") == 0, c("k"))).alias("zero"),
        F.countDistinct(F.when(c("v") > 1, c("k"))).alias("high"),
        F.sum("v").alias("total"),
    )
    assert rows(got.select(want.columns), "g") == rows(want, "g")
    unique = df.where("k is not null").dropDuplicates(["k"])
    assert rows(ops.conditional_counts(unique, ["g"], "k", conditions), "g") == rows(
        ops.conditional_counts(unique, ["g"], "k", conditions, key_unique=True), "g")


def skewed(seed, n=600):
    random.seed(seed)
    hot = [("hot", round(random.choice([0, 1, 2, -3.5, 1e6]) * random.random(), 2)) for _ in range(n)]
    rest = [(f"g{i % 7}", None if i % 11 == 0 else float(i % 13)) for i in range(n // 2)]
    return hot + rest


def test_median_by_selection(spark):
    data = skewed(2)
    df = spark.createDataFrame(data, "g string, v double")
    values = defaultdict(list)
    for g, v in data:
        if v is not None:
            values[g].append(v)
    got = dict(rows(ops.grouped_median(df, ["g"], "v", "m"), "g"))
    assert {g: round(m, 9) for g, m in got.items()} == {g: round(median(v), 9) for g, v in values.items()}


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", None), ("b", 5)], "g string, v int")
    assert rows(ops.grouped_mode(df, ["g"], "v", "m"), "g") == [("a", 1), ("b", 5)]


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "int"])
@pytest.mark.parametrize("key_kind", ["string", "bigint"])
def test_rank_in_pieces_equals_plain_rank(spark, kind, key_kind):
    data = [(g, v, i * 7919 % 1000) for i, (g, v) in enumerate(skewed(3))]
    df = spark.createDataFrame(data, "g string, v double, id int").select(
        "g", c("v").cast(kind).alias("v"), c("id").cast(key_kind).alias("id"))
    in_pieces = ops.rank_by_pieces(df, ["g"], "v", "r", ["id"])
    plain = ops.rank_by(df, ["g"], {"r": "v"}, ["id"])
    assert rows(in_pieces, "g", "r", "id") == rows(plain, "g", "r", "id")


def test_key_flags_count_distinct_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 1, 1), ("a", 2, 1), ("a", None, 9), ("b", 1, 1), ("b", 1, 1)], "g string, k int, v int"
    )
    flags = ops.key_flags(df, ["g"], "k", {"keys": None, "high": c("v") > 3})
    got = flags.groupBy("g").agg(F.sum("keys").alias("keys"), F.sum("high").alias("high"), F.sum("v").alias("v"))
    assert rows(got, "g") == [("a", 2, 1, 16), ("b", 1, 0, 2)]


def test_slices_are_even_and_in_order(spark):
    """A hot group with ties and a common prefix in its keys is spread over the slices."""
    from layercake.operators.slices import SLICE, in_slices

    data = [("hot", 7.0, f"Customer#{i:09d}") for i in range(4000)] + [(f"g{i % 5}", float(i), "x") for i in range(400)]
    sliced = in_slices(spark.createDataFrame(data, "g string, v double, id string"), "g", c("v").desc(), "id")
    found = defaultdict(list)
    for r in sliced.collect():
        found[r[SLICE]].append((r["g"], -r["v"], r["id"]))
    assert len(found) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(map(len, found.values())) < 2 * len(data) / len(found)
    in_order = sorted(found)
    assert all(max(found[a]) < min(found[b]) for a, b in zip(in_order, in_order[1:]))


@pytest.mark.parametrize("kind", ["string", "timestamp", "date", "boolean"])
def test_rank_in_pieces_breaks_ties_of_any_type(spark, kind):
    df = spark.range(1500).select(
        F.lit("a").alias("g"), (c("id") % 2).alias("v"), F.concat(F.lit("Customer#"), F.lpad(c("id").cast("string"), 9, "0")).alias("text"), "id")
    first = {"string": c("text"), "timestamp": F.timestamp_seconds(c("id") * 7919 % 1501), "boolean": c("id") % 3 == 0,
             "date": F.date_add(F.lit("2020-01-01").cast("date"), (c("id") * 7919 % 1501).cast("int"))}[kind]
    df = df.select("g", "v", first.alias("first"), "id")
    assert rows(ops.rank_by_pieces(df, ["g"], "v", "r", ["first", "id"]), "r") == rows(
        ops.rank_by(df, ["g"], {"r": "v"}, ["first", "id"]), "r")


def test_rank_in_pieces_with_many_ties_and_large_decimals(spark):
    data = [("a", 1, f"{i * 7919 % 997:04x}") for i in range(900)] + [("a", i % 3, f"k{i}") for i in range(90)]
    df = spark.createDataFrame(data, "g string, v int, id string").withColumn(
        "v", (c("v") + 12345678901234567).cast("decimal(28,4)") + (F.hash("id") % 3).cast("decimal(10,0)") / 10000)
    kept = df.withColumn("v", c("v").cast("decimal(28,4)"))
    assert rows(ops.rank_by_pieces(kept, ["g"], "v", "r", ["id"]), "r") == rows(
        ops.rank_by(kept, ["g"], {"r": "v"}, ["id"]), "r")
    ties = df.withColumn("v", F.lit(5))
    assert rows(ops.rank_by_pieces(ties, ["g"], "v", "r", ["id"]), "r") == rows(
        ops.rank_by(ties, ["g"], {"r": "v"}, ["id"]), "r")


def test_rolling_average_and_lag_count_rows_not_days(spark):
    start = date(2001, 1, 1)
    days = [start + timedelta(d) for d in (0, 1, 2, 4, 5, 6, 7, 8)]
    df = spark.createDataFrame([("a", d, i + 1) for i, d in enumerate(days)], "g string, d date, v int")
    got = df.withColumn("avg", ops.rolling_avg(["g"], "d", "v", 7)).withColumn(
        "before", windows.lag_by(["g"], "d", "v", 7)).withColumn("growth", ops.lag_growth(c("v"), c("before")))
    last = got.orderBy("d").collect()
    assert last[-1]["avg"] == 5.0 and last[-1]["before"] == 1 and last[-1]["growth"] == 700.0
    assert last[-2]["before"] is None and last[-2]["growth"] == 0.0


def test_new_rows_take_only_what_is_above_the_mark(spark):
    at = datetime(2001, 1, 1, 10, 0)
    source = spark.createDataFrame([(1, at - timedelta(minutes=1)), (2, at), (3, at + timedelta(minutes=1))],
                                   "id int, ts timestamp_ntz")
    target = source.where("id < 3")
    assert [r[0] for r in rows(ops.new_rows(source, target, "ts", "ts"), "id")] == [3]
    assert ops.new_rows(source, target.where("false"), "ts", "ts").count() == 3
    assert ops.new_rows(source, None, "ts", "ts") is source


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = ops.upsert(target, batch, "k")
    assert rows(once, "k") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(ops.upsert(once, batch, "k"), "k") == rows(once, "k")
    with pytest.raises(ValueError):
        ops.upsert(target, batch.union(batch), "k")


def test_schema_policies(spark):
    target = spark.createDataFrame([(1, "a", "x")], "k int, v string, x string")
    batch = spark.createDataFrame([(2, "b", 5)], "k int, v string, y int")
    assert rows(ops.upsert(target, batch, "k", "sync"), "k") == [(1, "a", None), (2, "b", 5)]
    with pytest.raises(ValueError):
        ops.upsert(target, batch, "k", "fail")


def test_upsert_table_moves_keys_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, p int"
    ops.upsert_table(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], schema), path, "k",
                    partition_by="p")
    batch = spark.createDataFrame([(2, "moved", 3), (4, "new", 4)], schema)
    for _ in range(2):
        ops.upsert_table(batch, path, "k", partition_by="p")
    got = rows(ops.read_upserted(spark, path).select("k", "v", "p"), "k")
    assert got == [(1, "a", 1), (2, "moved", 3), (3, "c", 3), (4, "new", 4)]


def test_upsert_table_sync_rewrites_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    ops.upsert_table(spark.createDataFrame([(1, "a", 1)], "k int, v string, p int"), path, "k", "sync", "p")
    ops.upsert_table(spark.createDataFrame([(2, 9, 2)], "k int, w int, p int"), path, "k", "sync", "p")
    assert rows(ops.read_upserted(spark, path).select("k", "w", "p"), "k") == [(1, None, 1), (2, 9, 2)]


DOCS = {
    "good.v1.json": {"project_config": {"database": "d", "schema": "s", "project_name": "p"}, "tasks": [
        {"name": "a", "dbt_command": "run", "depends_on": []},
        {"name": "b", "dbt_command": "run", "enabled": False, "depends_on": ["a"]},
        {"name": "c", "dbt_command": "test", "enabled": True, "depends_on": ["a", "b", "gone"]}]},
    "nosection.json": {"tasks": []},
    "nofield.json": {"project_config": {"database": "d", "project_name": "p"}, "tasks": []},
    "notasks.json": {"project_config": {"database": "d", "schema": "s", "project_name": "p"}, "tasks": []},
    "badtask.json": {"project_config": {"database": "d", "schema": "s", "project_name": "p"},
                     "tasks": [{"name": "a", "dbt_command": "run"}, {"dbt_command": "run"}, {"name": "x"}]},
}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("docs")
    for name, content in DOCS.items():
        (folder / name).write_text(json.dumps(content))
    return ops.load_json_docs(spark, str(folder), F.lit(datetime(2024, 1, 1)))


def test_documents_are_named_after_their_files(docs):
    assert [r[0] for r in rows(docs.select("feed_name"), "feed_name")] == [
        "badtask", "good.v1", "nofield", "nosection", "notasks"]


def test_first_fault_of_a_document(docs):
    got = {r["feed_name"]: (r["is_valid"], r["message"]) for r in ops.validate_document(docs).collect()}
    assert got["good.v1"] == (True, "Configuration is valid for feed: good.v1")
    assert got["nosection"][1] == "Error: Missing project_config section for feed: nosection"
    assert got["nofield"][1] == "Error: Missing required field: project_config.schema for feed: nofield"
    assert got["notasks"][1] == "Error: Missing or empty tasks array for feed: notasks"
    assert got["badtask"][1] == "Error: Task 2 is missing name field for feed: badtask"


def test_tasks_in_order_with_default_flag(docs):
    got = ops.feed_items(docs, "good.v1").orderBy("index").collect()
    assert [(r["task_name"], r["enabled"]) for r in got] == [("a", True), ("b", False), ("c", True)]
    assert [r["depends_on"] for r in got] == [[], ["a"], ["a", "b", "gone"]]
    summary = ops.feed_summary(docs).where("feed_name = 'good.v1'").first()
    assert (summary["total_tasks"], summary["enabled_tasks"], summary["disabled_tasks"]) == (3, 2, 1)


def test_only_enabled_dependencies_stay(docs):
    got = ops.dependency_filter(docs).where("feed_name = 'good.v1'").orderBy("index").collect()
    assert [(r["task_name"], r["depends_on"]) for r in got] == [("a", []), ("c", ["a"])]


def test_replaced_documents(docs):
    again = docs.where("feed_name = 'notasks'").withColumn("loaded_at", F.lit(datetime(2025, 1, 1)))
    merged = ops.replace_docs(docs, again)
    assert merged.count() == 5 and merged.where("loaded_at > '2024-06-01'").count() == 1


# ---------------------------------------------------------------------- upserts that fail or have odd partitions


def test_upsert_keeps_a_partition_with_a_null_value(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, p int"
    ops.upsert_table(spark.createDataFrame([(1, None), (2, 7)], schema), path, "k", partition_by="p")
    for _ in range(2):
        ops.upsert_table(spark.createDataFrame([(3, None)], schema), path, "k", partition_by="p")
    assert rows(ops.read_upserted(spark, path), "k") == [(1, None), (2, 7), (3, None)]


@pytest.mark.parametrize("by, fails", [(None, "_point"), (None, "commit"), *[("p", f) for f in ("_point", "_declare", "_take_over", "commit")]])
def test_upsert_that_fails_leaves_the_table_and_can_be_repeated(spark, tmp_path, monkeypatch, by, fails):
    from layercake.sources import catalog

    path, schema = str(tmp_path / "t"), "k int, p int"
    ops.upsert_table(spark.createDataFrame([(1, 1), (2, 2)], schema), path, "k", partition_by=by)
    batch = spark.createDataFrame([(3, 1), (2, 1)], schema)

    def broken(*_, **__):
        raise OSError("the disk is full")

    with monkeypatch.context() as patched, pytest.raises(OSError, match="full"):
        patched.setattr(catalog, fails, broken)
        ops.upsert_table(batch, path, "k", partition_by=by)
    assert rows(ops.read_upserted(spark, path), "k") == [(1, 1), (2, 2)]
    ops.upsert_table(batch, path, "k", partition_by=by)
    assert rows(ops.read_upserted(spark, path), "k") == [(1, 1), (2, 1), (3, 1)]


def test_a_first_upsert_that_fails_can_be_repeated(spark, tmp_path, monkeypatch):
    from layercake.sources import catalog

    path, batch = str(tmp_path / "t"), spark.createDataFrame([(1, 1)], "k int, p int")
    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(catalog, "folder_of", lambda *_: (_ for _ in ()).throw(OSError()))
        ops.upsert_table(batch, path, "k", partition_by="p")
    ops.upsert_table(batch, path, "k", partition_by="p")
    assert rows(ops.read_upserted(spark, path), "k") == [(1, 1)]


def test_upserted_tables_have_names_that_other_sessions_read(spark):
    schema, name = "k int, p string, v variant", f"silver.upserted_{uuid.uuid4().hex}"
    batch = spark.createDataFrame([(1, "a"), (2, None)], "k int, p string").withColumn("v", F.parse_json(F.lit("[1]")))
    ops.upsert_table(batch, name, "k", partition_by="p")
    before = set(spark.table(name).inputFiles())
    ops.upsert_table(batch.where("k = 1").withColumn("p", F.lit("a")), name, "k", partition_by="p")
    other = spark.newSession().table(name)
    assert other.schema == spark.createDataFrame([], schema).schema and rows(other.select("k", "p"), "k") == [(1, "a"), (2, None)]
    # The folder that holds no key of the batch is taken over as it is.
    kept = before & set(other.inputFiles())
    assert len(kept) == 1 and "null" in kept.pop()
    from layercake.sources import catalog

    assert len(catalog.forget_versions(spark, name)) == 2 and catalog.forget_versions(spark, name) == []
    assert rows(spark.table(name).select("k", "p"), "k") == [(1, "a"), (2, None)]


def test_files_that_the_catalog_does_not_know_are_not_overwritten(spark, tmp_path):
    from layercake.sources.catalog import UnknownTable

    path, batch = str(tmp_path / "t"), spark.createDataFrame([(1, 1)], "k int, p int")
    batch.write.parquet(path)
    with pytest.raises(UnknownTable):
        ops.upsert_table(batch, path, "k")


def test_upsert_keeps_text_partitions_as_they_are(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, p string"
    ops.upsert_table(spark.createDataFrame([(1, "007"), (2, "a/b=c")], schema), path, "k", partition_by="p")
    ops.upsert_table(spark.createDataFrame([(3, "007"), (4, "")], schema), path, "k", partition_by="p")
    assert rows(ops.read_upserted(spark, path), "k") == [(1, "007"), (2, "a/b=c"), (3, "007"), (4, "")]


def test_upsert_of_a_key_that_decides_the_partition_needs_no_look_up(spark, tmp_path, monkeypatch):
    from layercake.sources import catalog

    path, schema, read = str(tmp_path / "t"), "k int, p int", []
    ops.upsert_table(spark.createDataFrame([(1, 0), (11, 1)], schema), path, "k", partition_by="p")
    plain_rows = catalog.rows
    monkeypatch.setattr(catalog, "rows", lambda s, v, only=None: read.append(only) or plain_rows(s, v, only))
    ops.upsert_table(spark.createDataFrame([(12, 1)], schema), path, "k", partition_by="p", key_decides_partition=True)
    assert [only for only in read if only is not None] == [{"v-1-83DCEFB7"}]
    monkeypatch.undo()
    assert rows(ops.read_upserted(spark, path), "k") == [(1, 0), (11, 1), (12, 1)]
