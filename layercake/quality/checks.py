"""Data tests on DataFrames.

A test counts failing rows, and NULL fails none but ``not_null``. All row-level tests of a table share one aggregate,
or are observed while the table is written (``Watched``); its uniqueness tests share another, on counts per rule and
value; relationships are one aggregate each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

RESULT = "model string, column string, test string, severity string, failures bigint"


@dataclass(frozen=True)
class Rule:
    """``column`` names the tested column, or the tested statement for an expression."""

    column: str
    test: str  # unique, not_null, accepted_values, accepted_range, relationships, expression_is_true
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    parent: str | None = None
    field: str | None = None
    expression: str | None = None
    where: str | None = None
    severity: str = "error"


def _failing(rule: Rule) -> Column:
    """TRUE for a failing row."""
    column = F.col(rule.column) if rule.expression is None else None
    if rule.test == "not_null":
        return column.isNull()
    if rule.test == "accepted_values":
        return ~column.isin(*rule.values)
    if rule.test == "accepted_range":
        bounds = [column.cast("double") < rule.low] if rule.low is not None else []
        if rule.high is not None:
            bounds.append(column.cast("double") > rule.high)
        return reduce(lambda a, b: a | b, bounds)
    if rule.test == "expression_is_true":
        return ~F.expr(rule.expression)
    raise ValueError(f"{rule.test} is not a row-level test")


def _result(model: str, rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.test).alias("test"),
        F.lit(rule.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def is_row_level(rule: Rule) -> bool:
    return rule.test not in ("unique", "relationships")


def failure_counts(rules: Sequence[Rule]) -> list[Column]:
    """One aggregate ``_<number>`` per row-level rule."""
    counts = []
    for number, rule in enumerate(rules):
        failing = _failing(rule)
        if rule.where is not None:
            failing = F.expr(rule.where) & failing
        counts.append(F.count(F.when(failing, 1)).alias(f"_{number}"))
    return counts


def _as_rows(counted: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule from the one row of ``counted``."""
    results = [_result(model, rule, F.col(f"_{n}")) for n, rule in enumerate(rules)]
    return counted.select(F.explode(F.array(*results)).alias("_r")).select("_r.*")


def _row_level(df: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    return _as_rows(df.agg(*failure_counts(rules)), model, rules)


class Watched:
    """Row-level rules of a model that are counted while its rows are written, by the write itself."""

    def __init__(self, model: str, rules: Sequence[Rule]) -> None:
        self.model, self.rules = model, [rule for rule in rules if is_row_level(rule)]
        self._seen = Observation(f"rules of {model}")

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *failure_counts(self.rules)) if self.rules else df

    def results(self, spark: SparkSession) -> DataFrame:
        """After the write: (model, column, test, severity, failures) as ``check`` gives them."""
        seen = self._seen.get if self.rules else {}
        rows = [(self.model, r.column, r.test, r.severity, int(seen[f"_{n}"])) for n, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, RESULT)


def _value_counts(df: DataFrame, rule: Rule) -> DataFrame:
    """(value, n) of the non-NULL values: combined in the map tasks, so hot values do not matter."""
    rows = df.where(rule.where) if rule.where is not None else df
    value = F.col(rule.column)
    return rows.where(value.isNotNull()).groupBy(value.alias("_value")).agg(F.count("*").alias("_n"))


def _unique(df: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """All unique rules of a table in one pass: one shuffle by (rule, value) serves them all.

    A value repeats if it has a second row. Rows are sorted, which can spill, and of every value two rows at most leave a map
    task, so neither many values nor hot ones fill a task's memory.
    """
    held = []
    for number, rule in enumerate(rules):
        value = F.col(rule.column)
        if isinstance(df.schema[rule.column].dataType, (FloatType, DoubleType)):
            value = value + F.lit(0.0)  # the two zeros are one value
        present = value.isNotNull() if rule.where is None else F.expr(rule.where) & value.isNotNull()
        held.append(F.when(present, F.struct(F.lit(number).alias("rule"), value.cast("string").alias("value"))))
    stacked = df.select(F.explode(F.array_compact(F.array(*held))).alias("_v")).select("_v.*")
    same = Window.partitionBy("rule", "value").orderBy("rule")
    second = stacked.withColumn("_n", F.row_number().over(same)).where("_n = 2")
    repeated = [F.count_if(F.col("rule") == n).alias(f"_{n}") for n in range(len(rules))]
    return _as_rows(second.agg(*repeated), model, rules)


def _relationship(df: DataFrame, model: str, rule: Rule, parent: DataFrame) -> DataFrame:
    keys = parent.select(F.col(rule.field).alias("_value"))
    orphans = _value_counts(df, rule).join(keys, "_value", "left_anti")
    total = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_f"))
    return total.select(_result(model, rule, F.col("_f")).alias("_r")).select("_r.*")


def check(
    df: DataFrame,
    model: str,
    rules: Sequence[Rule],
    lookup: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """One row per rule: (model, column, test, severity, failures).

    ``lookup`` gives the parent table of a relationship by name.
    """
    parts = []
    simple = [rule for rule in rules if is_row_level(rule)]
    if simple:
        parts.append(_row_level(df, model, simple))
    unique = [rule for rule in rules if rule.test == "unique"]
    if unique:
        parts.append(_unique(df, model, unique))
    for rule in rules:
        if rule.test == "relationships":
            parts.append(_relationship(df, model, rule, lookup(rule.parent)))
    return reduce(DataFrame.unionByName, parts)
