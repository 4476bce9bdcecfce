"""All models by name, with their tags, and the ordered build."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from layercake import functions as fn
from layercake import rules
from layercake.operators.counts import keys_repeat
from layercake.operators.incremental import new_rows, read_upserted, replace_table, upsert_table
from layercake.operators.settle import settle
from layercake.plans import analytics, calendar, dimensions, facts, intermediate, staging
from layercake.plans.dimensions import key_table
from layercake.plans.run import Run
from layercake.sources.sinks import layer_name, write_table
from layercake.sources import catalog

if TYPE_CHECKING:
    from layercake.quality.checks import Watched

DEFAULT_SCHEMA = "default"
_LEAST_IDS_PER_PART, _PARTS = 10_000_000, 500


@dataclass(frozen=True)
class Incremental:
    """How a model grows: its key, the mark, the schema policy and its partitions."""

    key: str
    source: str  # the input that is filtered
    source_col: str
    target_col: str
    policy: str
    part: Callable[[str, int], Column]
    by_key: bool = False  # the partition is a function of the key
    bucket: str = ""  # what the rows are joined on


@dataclass(frozen=True)
class Model:
    make: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    tags: frozenset[str]
    layer: str | None
    kind: str = "table"  # view, table or incremental
    grows: Incremental | None = field(default=None)


def _day_number(column: str) -> Callable[[str, int], Column]:
    patterns = {"day": "yyyyMMdd", "month": "yyyyMM", "year": "yyyy"}
    return lambda grain, _: F.date_format(column, patterns[grain]).cast("int")


def _id_range(column: str) -> Callable[[str, int], Column]:
    return lambda _, width: F.floor(F.col(column) / width).cast("int")


def _staged(*extra: str) -> frozenset[str]:
    return frozenset({"silver", "staging", *extra})


_MIDDLE = frozenset({"silver", "intermediate"})
_CORE = frozenset({"gold", "core", "dimension"})
_FACT = frozenset({"gold", "core", "fact"})


def _mart(*extra: str) -> frozenset[str]:
    return frozenset({"gold", "analytics", *extra})


_HEADERS = Incremental(
    "order_id", "order_header", "order_ts", "order_timestamp", "fail", _day_number("order_timestamp"),
    bucket="order_id",
)
_DETAILS = Incremental(
    "order_detail_id", "order_detail", "order_detail_id", "order_detail_id", "fail",
    _id_range("order_detail_id"), by_key=True, bucket="order_id",
)
_ORDERS = Incremental(
    "order_id", "int_orders_enriched", "updated_ts", "updated_ts", "sync", _day_number("order_timestamp"),
    bucket="order_sk",
)
_LINES = Incremental(
    "order_detail_id", "stg_pos_order_details", "updated_ts", "updated_ts", "sync",
    _id_range("order_detail_id"), by_key=True, bucket="order_sk",
)

# In build order: every model follows its inputs. Names, layers, tags, keys.
MODELS: dict[str, Model] = {
    "dim_date": Model(calendar.dim_date, (), frozenset({"utils"}), "gold"),
    "dim_time": Model(calendar.dim_time, (), frozenset({"utils"}), "gold"),
    "stg_pos_countries": Model(staging.stg_pos_countries, ("country",), _staged("pos"), "silver", "view"),
    "stg_pos_franchises": Model(staging.stg_pos_franchises, ("franchise",), _staged("pos"), "silver", "view"),
    "stg_pos_locations": Model(staging.stg_pos_locations, ("location",), _staged("pos"), "silver", "view"),
    "stg_pos_menu": Model(staging.stg_pos_menu, ("menu",), _staged("pos"), "silver", "view"),
    "stg_pos_trucks": Model(staging.stg_pos_trucks, ("truck",), _staged("pos"), "silver", "view"),
    "stg_customer_loyalty": Model(
        staging.stg_customer_loyalty, ("customer_loyalty",), _staged("customer"), "silver", "view"
    ),
    "stg_pos_order_headers": Model(
        staging.stg_pos_order_headers, ("order_header",), _staged("pos", "orders"), "silver",
        "incremental", _HEADERS,
    ),
    "stg_pos_order_details": Model(
        staging.stg_pos_order_details, ("order_detail",), _staged("pos", "orders"), "silver",
        "incremental", _DETAILS,
    ),
    "int_orders_enriched": Model(
        intermediate.int_orders_enriched,
        ("stg_pos_order_headers", "stg_pos_order_details", "stg_pos_menu"), _MIDDLE, "silver",
    ),
    "int_menu_profitability": Model(
        intermediate.int_menu_profitability,
        ("stg_pos_menu", "stg_pos_order_details", "stg_pos_order_headers"), _MIDDLE, "silver",
    ),
    "int_customers_segmented": Model(
        intermediate.int_customers_segmented,
        ("stg_customer_loyalty", "int_orders_enriched"), _MIDDLE, "silver",
    ),
    "dim_country": Model(dimensions.dim_country, ("stg_pos_countries",), _CORE, "gold"),
    "dim_city": Model(dimensions.dim_city, ("stg_pos_countries",), _CORE, "gold"),
    "dim_location": Model(dimensions.dim_location, ("stg_pos_locations",), _CORE, "gold"),
    "dim_franchise": Model(dimensions.dim_franchise, ("stg_pos_franchises",), _CORE, "gold"),
    "dim_truck": Model(dimensions.dim_truck, ("stg_pos_trucks", "dim_franchise"), _CORE, "gold"),
    "dim_customer": Model(dimensions.dim_customer, ("int_customers_segmented",), _CORE, "gold"),
    "dim_menu_item": Model(dimensions.dim_menu_item, ("int_menu_profitability",), _CORE, "gold"),
    "fact_order": Model(
        facts.fact_order,
        ("int_orders_enriched", "truck_keys", "location_keys", "customer_keys", "dim_date", "dim_time"),
        _FACT, "gold", "incremental", _ORDERS,
    ),
    "fact_order_detail": Model(
        facts.fact_order_detail, ("stg_pos_order_details", "order_keys", "item_keys"), _FACT, "gold",
        "incremental", _LINES,
    ),
    "agg_daily_sales": Model(
        analytics.agg_daily_sales, ("fact_order", "dim_date", "dim_truck", "dim_location"),
        _mart("aggregation"), "gold",
    ),
    "agg_location_insights": Model(
        analytics.agg_location_insights, ("fact_order", "dim_date", "dim_location", "dim_truck"),
        _mart("location"), "gold",
    ),
    "agg_menu_performance": Model(
        analytics.agg_menu_performance,
        ("order_lines", "order_heads", "dim_date", "dim_menu_item", "dim_truck"),
        _mart("menu"), "gold",
    ),
    "agg_customer_360": Model(
        analytics.agg_customer_360,
        ("dim_customer", "order_heads", "order_lines", "dim_truck", "dim_location",
         "dim_menu_item", "dim_date"),
        _mart("customer"), "gold",
    ),
}

# Key tables for the fact lookups: the members of a dimension without its other columns.
_KEYS: dict[str, Callable[["Layers"], DataFrame]] = {
    "truck_keys": lambda layers: key_table(layers["stg_pos_trucks"], "truck_id", "truck_sk"),
    "location_keys": lambda layers: key_table(layers["stg_pos_locations"], "location_id", "location_sk"),
    "customer_keys": lambda layers: key_table(layers["stg_customer_loyalty"], "customer_id", "customer_sk"),
    "item_keys": lambda layers: key_table(
        layers["stg_pos_menu"].where("has_valid_pricing"), "menu_item_id", "menu_item_sk",
        ("cost_of_goods_usd", "item_category", "item_subcategory", "truck_brand_name",
         "is_vegetarian", "is_vegan", "is_gluten_free"),
    ),
    # The fact has one row per staged order, and staged orders are stored by their ids.
    "order_keys": lambda layers: layers.built("stg_pos_order_headers", "fact_order").select("order_id"),
    "order_lines": lambda layers: layers.order_lines(),
    "order_heads": lambda layers: layers.order_heads(),
}

# What the customer mart and the history of its customers read of the orders.
_ORDER_COLUMNS = (
    "order_id", "order_channel", "meal_period", "order_total", "processing_time_minutes", "line_item_count",
    "discount_percentage",
)
# Inputs that a model reads more than once, and the columns that it needs of them. With ``write_shared`` these are written once
# to the shared folder instead of being computed for every use; without it, composing a model starts no job.
_READ_OFTEN = {
    "agg_customer_360": {
        "int_orders_enriched": (*_ORDER_COLUMNS, "truck_id", "location_id", "customer_id", "order_timestamp"),
        "order_heads": (*_ORDER_COLUMNS, "order_sk", "truck_sk", "location_sk", "customer_sk", "order_date_sk"),
    },
}
# Marts in steps. With ``write_shared`` results of steps, which have far fewer bytes than the shuffles that made them, are written apart,
# so that no more than one step's shuffles are held at a time.
_IN_STEPS = ("agg_menu_performance", "agg_customer_360")


def select(tags: Iterable[str] | None) -> list[str]:
    """Models that carry all the given tags, in build order; None selects every model."""
    wanted = frozenset(tags or ())
    return [name for name, model in MODELS.items() if wanted <= model.tags]


class Layers:
    """The models over one set of raw tables, each composed when first asked for."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        run: Run,
        calendar_start: str | date = rules.CALENDAR_START,
        calendar_end: str | date = rules.CALENDAR_END,
        write_shared: bool = False,
    ):
        self._write_shared = write_shared
        self.spark, self.run = spark, run
        self._calendar = (calendar_start, calendar_end)
        self._raw = raw
        self._known: dict[str, DataFrame] = {}
        self._tables: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._raw:
            return self._raw[name]
        if name not in self._known:
            self._known[name] = _KEYS[name](self) if name in _KEYS else self.compose(name)
        return self._known[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        """From here on the model is this written table."""
        self._known[name] = table
        self._tables.add(name)

    def keep(self, name: str, columns: Iterable[str]) -> None:
        """From here on the model is a table of these columns, written to the shared folder; its other columns are NULL."""
        whole = self["order_heads"] if name == "fact_order" else self[name]
        # The key of a customer follows from the id, which is written in its place.
        by_id = {"customer_sk": "customer_id"} if "customer_sk" in columns and "customer_id" in whole.columns else {}
        kept = settle(whole.select(*dict.fromkeys(by_id.get(column, column) for column in columns)), name)
        held = {sk: fn.member_key(F.col(key)) for sk, key in by_id.items()} | {column: F.col(column) for column in kept.columns}
        self[name] = kept.select(
            *[held.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in whole.schema]
        )

    def _apart(self) -> Layers:
        """The same layers with the tables so far; tables that come to them stay theirs."""
        apart = Layers(self.spark, self._raw, self.run, *self._calendar)
        for name in self._tables:
            apart[name] = self._known[name]
        return apart

    def order_lines(self) -> DataFrame:
        """The order lines for marts: the written fact, else the fact with the ids that the composed lines are shuffled by."""
        if "fact_order_detail" in self._tables:
            return self["fact_order_detail"]
        made_of = [self[i] for i in MODELS["fact_order_detail"].inputs]
        return facts.fact_order_detail(*made_of, self.run, ids=True)

    def order_heads(self) -> DataFrame:
        """The orders for marts: the written fact, else the fact with the ids of its customers."""
        if "fact_order" in self._tables:
            return self["fact_order"]
        return facts.fact_order(*[self[i] for i in MODELS["fact_order"].inputs], self.run, ids=True)

    def built(self, *names: str) -> DataFrame:
        """The first of the models that is a written table, else the first."""
        return self[next((name for name in names if name in self._tables), names[0])]

    def compose(self, name: str, replaced: Mapping[str, DataFrame] | None = None) -> DataFrame:
        model = MODELS[name]
        if name == "dim_date":
            return model.make(self.spark, *self._calendar)
        if name == "dim_time":
            return model.make(self.spark)
        given = replaced or {}
        source = self
        if self._write_shared and name in _READ_OFTEN:
            source = self._apart()
            for often, columns in _READ_OFTEN[name].items():
                if often not in source._tables and not (often == "order_heads" and "fact_order" in source._tables):
                    # Lines of a written fact meet the orders by surrogate keys, others by ids.
                    by_ids = "fact_order_detail" not in source._tables
                    source.keep(often, [column for column in columns if not (by_ids and column == "order_sk")])
        made_of = [given[i] if i in given else source[i] for i in model.inputs]
        if self._write_shared and name in _IN_STEPS:
            return model.make(*made_of, self.run, apart=settle)
        return model.make(*made_of, self.run)


class GateFailed(RuntimeError):
    """A data test of severity error failed, so later layers are not built; ``failing`` has the result rows."""

    def __init__(self, failing: list[Row]) -> None:
        lines = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failing]
        super().__init__("data tests failed: " + "; ".join(lines))
        self.failing = failing


def _location(base: str, name: str) -> str:
    return f"{base}/{layer_name(MODELS[name].layer, DEFAULT_SCHEMA)}/{name}"


def _existing(spark: SparkSession, name: str, path: str) -> DataFrame | None:
    """What an earlier build left, None if nothing is there; a table that cannot be read is an error."""
    if MODELS[name].grows is not None:
        table = read_upserted(spark, path)
        return None if table is None else table.drop("_part")
    return spark.read.parquet(path) if catalog.files_below(spark, path) else None


def _materialize(
    layers: Layers, name: str, base: str, full_refresh: bool, grain: str, buckets: int, watched: Watched | None
) -> DataFrame:
    spark, model, path = layers.spark, MODELS[name], _location(base, name)
    watch = watched.watch if watched else lambda rows: rows
    if model.kind == "view":
        return layers[name]
    if model.grows is None:
        return write_table(watch(layers.compose(name)), path)
    grows = model.grows
    target = None if full_refresh else _existing(spark, name, path)
    before = catalog.newest(spark, path) if target is not None else None
    by_footers = before is not None and not before.mixed
    fresh = new_rows(layers[grows.source], target, grows.source_col, grows.target_col, by_footers)
    batch = layers.compose(name, {grows.source: fresh})
    width = 1
    if grows.by_key:
        width = int(before.properties["width"]) if before else _id_width(batch, grows.key)
    batch = watch(batch).withColumn("_part", grows.part(grain, width))
    dealt = catalog.Buckets((grows.bucket,), buckets) if buckets and grows.bucket else None
    if not dealt:
        # Evens out the files of a partition without putting a large day into one task.
        batch = batch.hint("rebalance", "_part")
    keys = [field.name for field in batch.schema if field.name.endswith("_sk") and field.dataType.typeName() == "string"]
    if target is None:
        replace_table(batch, path, "_part", {"width": width}, dealt, keys)
    else:
        upsert_table(batch, path, grows.key, grows.policy, "_part", grows.by_key, keys=keys)
    return read_upserted(spark, path).drop("_part")


def _id_width(batch: DataFrame, key: str) -> int:
    """Ids of one partition: so many that the first load has some hundred partitions, ten million at least."""
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return max(_LEAST_IDS_PER_PART, ((high or 0) - (low or 0)) // _PARTS + 1)


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    run: Run,
    base: str,
    tags: Iterable[str] | None = None,
    gates: bool = True,
    known_failures: Iterable[tuple[str, str, str]] = (),
    full_refresh: bool = False,
    grain: str = "day",
    buckets: int = 0,
    calendar_start: str | date = rules.CALENDAR_START,
    calendar_end: str | date = rules.CALENDAR_END,
) -> dict[str, DataFrame]:
    """Build the selected models under ``base``, layer by layer.

    Models that are not selected are read from ``base`` where an earlier build left them and
    composed otherwise. Incremental models take only rows above their mark, unless
    ``full_refresh``. With ``buckets`` they are stored in so many buckets by what they are joined on, so
    that those joins need no shuffle. With ``gates`` the data tests of each table group decide whether the next one is
    built; a failing test of severity error stops the build, except for the ``known_failures`` given as (model,
    column, test). Row-level tests of tables are counted by the write itself, of an increment for the rows it
    brings; only uniqueness, relationships and the tests of views are passes of their own.
    """
    # Models and tests refer to each other.
    from layercake.quality.catalogue import RULES
    from layercake.quality.checks import Watched
    from layercake.quality.suite import check_models

    layers = Layers(spark, raw, run, calendar_start, calendar_end)
    selected = select(tags)
    for name, model in MODELS.items():
        if name not in selected and model.kind != "view":
            built = _existing(spark, name, _location(base, name))
            if built is not None:
                layers[name] = built
    done: dict[str, DataFrame] = {}
    groups = ["utils", "staging", "intermediate", "core", "analytics"]
    for group in groups:
        names = [n for n in selected if group in MODELS[n].tags]
        if names and group == "analytics":
            layers.run = replace(run, unique_orders=not keys_repeat(layers["fact_order"], "order_id"))
        tested = [n for n in names if gates and n in RULES]
        watched = {n: Watched(n, RULES[n]) for n in tested if MODELS[n].kind != "view"}
        for name in names:
            done[name] = layers[name] = _materialize(
                layers, name, base, full_refresh, grain, buckets, watched.get(name)
            )
        if tested:
            _gate(check_models(layers, tested, watched), set(known_failures))
    return done


def _gate(results: DataFrame, known: set[tuple[str, str, str]]) -> None:
    """Raise on failing error-level tests. There is one result row per declared test."""
    failing = results.where((F.col("failures") > 0) & (F.col("severity") == "error")).collect()
    failing = [r for r in failing if (r["model"], r["column"], r["test"]) not in known]
    if failing:
        raise GateFailed(failing)
