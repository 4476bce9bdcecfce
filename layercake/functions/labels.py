"""Labels from values: synonyms, keywords, bands, rule tables and peaks."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "=": operator.eq,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda column, values: column.isin(*values),
}


def first_match(cases: Iterable[tuple[Column, Any]], default: Any) -> Column:
    """Value of the first case that is TRUE; FALSE and NULL fall through to the next one."""
    chain = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if chain is None else chain.otherwise(default)


def normalize(column: Column, synonyms: Mapping[str, Sequence[Any]], default: Any) -> Column:
    """Label whose synonym list holds the value (list the synonyms as the column spells them)."""
    return first_match([(column.isin(*words), label) for label, words in synonyms.items()], default)


def contains_any(column: Column, keywords: Sequence[str]) -> Column:
    return reduce(operator.or_, [column.contains(word) for word in keywords])


def keyword_class(column: Column, classes: Sequence[tuple[Sequence[str], Any]], default: Any) -> Column:
    """Label of the first keyword list of which any word occurs in the text."""
    return first_match([(contains_any(column, words), label) for words, label in classes], default)


def band(column: Column, op: str, limits: Sequence[tuple[Any, Any]], default: Any) -> Column:
    """Label of the first limit with ``column op limit``; NULL gets the default."""
    compare = _COMPARE[op]
    return first_match([(compare(column, F.lit(limit)), label) for limit, label in limits], default)


def between_band(column: Column, ranges: Sequence[tuple[tuple[Any, Any], Any]], default: Any) -> Column:
    """Label of the first inclusive range that holds the value."""
    return first_match([(column.between(low, high), label) for (low, high), label in ranges], default)


def classify(
    rules: Sequence[tuple[Any, Sequence[tuple[str, str, Any]]]], default: Any, **metrics: Column
) -> Column:
    """Label of the first rule whose conditions on the named metrics all hold."""
    cases = []
    for label, conditions in rules:
        tests = [
            _COMPARE[op](metrics[name], value if op == "in" else F.lit(value))
            for name, op, value in conditions
        ]
        cases.append((reduce(operator.and_, tests), label))
    return first_match(cases, default)


def flag(condition: Column) -> Column:
    """TRUE where the condition holds, FALSE where it does not or is NULL."""
    return F.coalesce(condition, F.lit(False))


def peak_of(measures: Sequence[tuple[Any, Column]]) -> Column:
    """Label of the largest measure; among equals the one listed first. Measures must not be NULL."""
    top = F.greatest(*[measure for _, measure in measures])
    return first_match([(measure == top, label) for label, measure in measures[:-1]], measures[-1][0])
