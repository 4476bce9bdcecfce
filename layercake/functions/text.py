"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake import rules


def clean_name(column: Column) -> Column:
    """Trimmed, first letter of each whitespace-separated word in upper case."""
    return F.initcap(F.trim(column))


def code(column: Column) -> Column:
    """Trimmed, upper case: the form in which synonym lists and codes are compared."""
    return F.upper(F.trim(column))


def full_name(*parts: Column) -> Column:
    """Cleaned parts joined by blanks; absent parts leave no blank at either end."""
    return F.trim(F.concat_ws(" ", *[F.coalesce(clean_name(part), F.lit("")) for part in parts]))


def is_email(column: Column) -> Column:
    return column.rlike(rules.EMAIL_PATTERN)


def clean_email(column: Column) -> Column:
    """Lower-case address, NULL unless the untrimmed text is an address."""
    return F.when(is_email(column), F.lower(F.trim(column)))


def digits(column: Column) -> Column:
    """The digits and plus signs of a phone number."""
    return F.regexp_replace(F.trim(column), rules.NON_DIGITS, "")


def non_blank(column: Column) -> Column:
    """Trimmed text, NULL where nothing is left."""
    return F.nullif(F.trim(column), F.lit(""))
