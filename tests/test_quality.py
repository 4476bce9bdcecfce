"""Data tests: what fails, what NULL does, and how many are declared."""

from collections import Counter

from layercake.plans.build import MODELS
from layercake.quality import Rule, check
from layercake.quality.catalogue import RULES


def failures(spark, df, *rules, parents=None):
    result = check(df, "t", list(rules), (parents or {}).get)
    return {(r["column"], r["test"]): r["failures"] for r in result.collect()}


def test_null_fails_only_not_null(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "x int")
    parent = spark.createDataFrame([(1,)], "x int")
    got = failures(
        spark, df, Rule("x", "unique"), Rule("x", "not_null"), Rule("x", "accepted_values", values=(1,)),
        Rule("x", "accepted_range", low=0, high=5), Rule("x", "relationships", parent="p", field="x"),
        Rule("named", "expression_is_true", expression="x = 1"), parents={"p": parent})
    assert got == {("x", "unique"): 0, ("x", "not_null"): 2, ("x", "accepted_values"): 0,
                   ("x", "accepted_range"): 0, ("x", "relationships"): 0, ("named", "expression_is_true"): 0}


def test_failing_rows_are_counted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "-1"), (3, "c")], "x int, y string")
    parent = spark.createDataFrame([("a",)], "y string")
    got = failures(
        spark, df, Rule("x", "unique"), Rule("x", "accepted_values", values=(1, 2)),
        Rule("x", "accepted_range", low=2), Rule("named", "expression_is_true", expression="x < 3"),
        Rule("y", "relationships", parent="p", field="y", where="y != '-1'"), parents={"p": parent})
    assert got == {("x", "unique"): 2, ("x", "accepted_values"): 1, ("x", "accepted_range"): 2,
                   ("named", "expression_is_true"): 1, ("y", "relationships"): 3}


def test_range_of_numbers_kept_as_text(spark):
    df = spark.createDataFrame([("5",), ("50",)], "x string")
    assert failures(spark, df, Rule("x", "accepted_range", high=10)) == {("x", "accepted_range"): 1}


def test_declared_tests():
    rules = [r for group in RULES.values() for r in group]
    assert Counter(r.test for r in rules) == {
        "unique": 25, "not_null": 97, "accepted_values": 38, "accepted_range": 47, "relationships": 12,
        "expression_is_true": 35}
    assert sum(r.where is not None for r in rules) == 27
    assert sum(r.severity == "warn" for r in rules) == 4
    assert set(RULES) <= set(MODELS)
    assert all(r.parent in MODELS for r in rules if r.parent)
