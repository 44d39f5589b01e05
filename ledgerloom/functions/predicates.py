"""Boolean conditions shared by the profiling, cleaning and report jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the feeds are checked against.
FEED_EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.example\.com$"
TITLE_CASE_PATTERN = r"^[A-Z][a-z]+$"


def is_missing(value: Column) -> Column:
    """Null or empty. Cast first: comparing a number with '' raises under ANSI rules."""
    return value.isNull() | (value.cast("string") == "")


def is_unexpected_email(email: Column, pattern: str = FEED_EMAIL_PATTERN) -> Column:
    """True where the address does not match; null addresses are left to ``is_missing``.

    The default pattern wants a host in front of ``.example.com``, so a plain
    ``user@example.com`` counts as unexpected.
    """
    return ~email.rlike(pattern)


def is_not_title_case(name: Column) -> Column:
    return ~name.rlike(TITLE_CASE_PATTERN)


def equals_ignoring_case(value: Column, wanted: str) -> Column:
    return F.lower(value) == wanted.lower()


def all_equal(**wanted) -> Column:
    """Conjunction of equalities, one for each named column."""
    return reduce(lambda a, b: a & b, [F.col(name) == value for name, value in wanted.items()])
