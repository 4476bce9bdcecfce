"""Pieces of SQL text, and common table expressions put together by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from layercake import rules
from layercake.sources.adapter import LINES, MAPPING

AS_OF = "DATE '2001-08-02'"
AS_OF_TS = "TIMESTAMP '2001-08-02 00:00:00'"
CALENDAR = ("1995-01-01", "2002-01-01")


def text(value: Any) -> str:
    """A literal."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def listed(values: Sequence[Any]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def case(cases: Sequence[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in cases) + f" ELSE {default} END"


def case_in(value: str, synonyms: Mapping[str, Sequence[Any]], default: str) -> str:
    return case([(f"{value} IN {listed(words)}", text(label)) for label, words in synonyms.items()], default)


def case_words(value: str, classes: Sequence[tuple[Sequence[str], Any]], default: str) -> str:
    return case([(any_word(value, words), text(label)) for words, label in classes], default)


def any_word(value: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({value}, {text(w)})" for w in words) + ")"


def case_band(value: str, op: str, limits: Sequence[tuple[Any, Any]], default: Any) -> str:
    return case([(f"{value} {op} {limit}", text(label)) for limit, label in limits], text(default))


def case_between(value: str, ranges: Sequence[tuple[tuple[int, int], str]], default: str) -> str:
    return case([(f"{value} BETWEEN {a} AND {b}", text(label)) for (a, b), label in ranges], text(default))


def case_rules(table: Sequence[tuple[Any, Sequence[tuple[str, str, Any]]]], default: Any, **metrics: str) -> str:
    cases = []
    for label, conditions in table:
        tests = [
            f"{metrics[name]} {op} {listed(v) if op == 'in' else text(v)}" for name, op, v in conditions
        ]
        cases.append((" AND ".join(tests), text(label)))
    return case(cases, text(default))


def peak(pairs: Sequence[tuple[str, str]]) -> str:
    top = "greatest(" + ", ".join(measure for _, measure in pairs) + ")"
    return case([(f"{measure} = {top}", text(label)) for label, measure in pairs], "NULL")


def initcap(value: str) -> str:
    words = f"string_split(lower(trim({value})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || substr(w, 2)), ' ')"


def key(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{rules.SURROGATE_NULL}')" for c in columns]
    return "md5(concat_ws('-', " + ", ".join(parts) + "))"


def pct(num: str, den: str, otherwise: str = "0", places: int | None = None) -> str:
    """Percentage by plain division; rounded where it meets limits that it may hit exactly."""
    value = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100"
    if places is not None:
        value = f"round({value}, {places})"
    return f"CASE WHEN {den} > 0 THEN {value} ELSE {otherwise} END"


def average(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)"


def r4(value: str) -> str:
    """Four places, half up, with a nudge that settles ties alike in both engines."""
    return f"floor(CAST({value} AS DOUBLE) * 10000 + 0.500001) / 10000"


# Column kinds in a specification: how a result column is delivered by both engines.
KINDS = {
    "l": "BIGINT", "i": "INTEGER", "s": "VARCHAR", "b": "BOOLEAN", "D": "DATE", "t": "TIMESTAMP",
    "d": "DOUBLE",
}


def columns_of(spec: str) -> list[tuple[str, str]]:
    """``"name:kind name:kind"`` as pairs; kind ``m`` is a measure rounded to four places."""
    return [tuple(item.split(":")) for item in spec.split()]


def deliver(spec: str) -> str:
    out = []
    for name, kind in columns_of(spec):
        out.append(f"{r4(name)} AS {name}" if kind == "m" else f"CAST({name} AS {KINDS[kind]}) AS {name}")
    return ", ".join(out)


def _interval(expression: str) -> str:
    """``MINSEC(m; s)`` as this engine writes intervals."""
    while "MINSEC(" in expression:
        start = expression.index("MINSEC(")
        depth, end = 0, start + 6
        for end in range(start + 6, len(expression)):
            depth += {"(": 1, ")": -1}.get(expression[end], 0)
            if depth == 0:
                break
        minutes, seconds = expression[start + 7:end].split("; ")
        expression = (
            f"{expression[:start]}(to_minutes({minutes}) + to_seconds({seconds})){expression[end + 1:]}"
        )
    return expression


def raw_cte(table: str) -> str:
    base, columns = MAPPING[table]
    if base == "lines":
        base = f"({LINES}) l LEFT JOIN part p ON p.p_partkey = l.pk"
    return "SELECT " + ", ".join(f"{_interval(e)} AS {c}" for c, e in columns.items()) + f" FROM {base}"


CTES: dict[str, tuple[tuple[str, ...], str]] = {f"raw_{table}": ((), raw_cte(table)) for table in MAPPING}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (tuple(needs.split()), sql)


def query(final: str, *needs: str) -> str:
    """``final`` after all the expressions it needs, directly or not, each once, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][0]:
            visit(need)
        order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + final


def model(name: str, spec: str) -> str:
    return query(f"SELECT {deliver(spec)} FROM {name}", name)
