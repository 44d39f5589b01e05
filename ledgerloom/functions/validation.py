"""Checks of change requests and report parameters, as column expressions over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters mean any alphabet, digits any decimal digit.
# The end of the text is \z where a final newline is refused, $ where it is let pass.
WORDS = r"^ *\p{L}[\p{L} ]*\z"
LETTERS = r"^\p{L}+\z"
FIVE_DIGITS = r"^\p{Nd}{5}\z"
PHONE = r"^\(\p{Nd}{3}\)\p{Nd}{3}-\p{Nd}{4}$"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
MONTH_OF_YEAR = r"^(1[0-2]|0?[1-9])/\p{Nd}{4}\z"
# The messages users know.
INVALID_FIELD = "Invalid field: "
INVALID_VALUE = "Invalid value for "


def _words_up_to(limit: int) -> Callable[[Column], Column]:
    return lambda value: (F.length(value) <= limit) & value.rlike(WORDS)


FIELD_RULES: dict[str, Callable[[Column], Column]] = {
    "FIRST_NAME": _words_up_to(50),
    "LAST_NAME": _words_up_to(50),
    "FULL_STREET_ADDRESS": lambda value: F.length(value) <= 100,
    "CUST_CITY": _words_up_to(50),
    "CUST_STATE": lambda value: (F.length(value) == 2) & value.rlike(LETTERS),
    "CUST_COUNTRY": _words_up_to(50),
    "CUST_ZIP": lambda value: value.rlike(FIVE_DIGITS),
    "CUST_PHONE": lambda value: value.rlike(PHONE),
    "CUST_EMAIL": lambda value: value.rlike(EMAIL),
}


def rejection_reason(field: Column, value: Column) -> Column:
    """Why a change is refused; null when it is acceptable."""
    known = field.isin(list(FIELD_RULES))
    valid = F.lit(False)
    for name, rule in FIELD_RULES.items():
        valid = F.when(field == name, rule(value)).otherwise(valid)
    return (
        F.when(~F.coalesce(known, F.lit(False)), F.concat(F.lit(INVALID_FIELD), F.coalesce(field, F.lit(""))))
        .when(~F.coalesce(valid, F.lit(False)), F.concat(F.lit(INVALID_VALUE), field))
    )


def is_zip_parameter(value: Column) -> Column:
    return F.coalesce(value.rlike(FIVE_DIGITS), F.lit(False))


def is_month_parameter(value: Column) -> Column:
    """``MM/YYYY`` with a month from 1 to 12 and a year from 1 on."""
    return F.coalesce(value.rlike(MONTH_OF_YEAR) & ~value.endswith("/0000"), F.lit(False))
