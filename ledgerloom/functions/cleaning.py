"""Standardisation of ZIP codes, phones, names, addresses and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the feeds' own conventions for right results.
NORTH_EAST_STATES = ["NJ", "CT", "NH", "MA", "VT", "RI", "ME"]
INVALID_PHONE = "Invalid phone number length"
GENERATED_EMAIL_DOMAIN = "@example.com"
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
TIME_ID_FORMAT = "yyyyMMdd"


def as_text(value: Column) -> Column:
    return value.cast("string")


def restore_zip_zero(zip_code: Column, state: Column) -> Column:
    """Four-digit ZIPs of the north-eastern states get their leading zero back.

    The cast comes first: mixing a number with text in ``when`` would turn the
    result into a number under ANSI rules and lose the zero again.
    """
    text = as_text(zip_code)
    lost_zero = (F.length(text) == 4) & state.isin(NORTH_EAST_STATES)
    return F.when(lost_zero, F.concat(F.lit("0"), text)).otherwise(text)


def zip_join_key(zip_code: Column) -> Column:
    """The form in which ZIPs of two feeds are compared, leading zeros included; a blank one is no ZIP."""
    text = as_text(zip_code)
    return F.when(F.trim(text) == "", F.lit(None).cast("string")).when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def format_ten_digit_phone(phone: Column) -> Column:
    """``(ddd)ddd-dddd``; a fixed message for any other length; null stays null."""
    text = as_text(phone)
    parts = [F.lit("("), text.substr(1, 3), F.lit(")"), text.substr(4, 3), F.lit("-"), text.substr(7, 4)]
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(F.length(text) == 10, F.concat(*parts))
        .otherwise(F.lit(INVALID_PHONE))
    )


def phone_with_area_code(area_code: Column, local_number: Column) -> Column:
    """``(AAA)xxx-xxxx`` from an area code and a seven-digit number; null if either is."""
    local = as_text(local_number)
    return F.concat(F.lit("("), area_code, F.lit(")"), local.substr(1, 3), F.lit("-"), local.substr(4, 4))


def first_area_code(area_codes: Column) -> Column:
    """The first entry of a list such as ``201/551``."""
    return F.split(area_codes, "/")[0]


def split_joined_words(name: Column) -> Column:
    """``ElPaso`` becomes ``El Paso``: a space at each lower-to-upper boundary."""
    return F.regexp_replace(name, "(?<=[a-z])(?=[A-Z])", " ")


def fix_mc_surname(name: Column) -> Column:
    """``Mckinney`` becomes ``McKinney``; names without the prefix are left alone."""
    fixed = F.concat(F.lit("Mc"), F.upper(name.substr(3, 1)), F.lower(F.substring(name, 4, 2**31 - 1)))
    return F.when(name.startswith("Mc") & (F.length(name) >= 3), fixed).otherwise(name)


def lower_name(name: Column) -> Column:
    return F.lower(name)


def initial(name: Column) -> Column:
    return F.substring(name, 1, 1)


def generated_email(first: Column, middle: Column, last: Column) -> Column:
    """First initial, middle initial and surname at the bank's domain; null if a part is."""
    return F.concat(initial(first), initial(middle), last, F.lit(GENERATED_EMAIL_DOMAIN))


def street_address(number: Column, street: Column) -> Column:
    """Number and street with a space between; null if either part is missing."""
    return F.concat(as_text(number), F.lit(" "), street)


def pad_date_part(part: Column) -> Column:
    return F.lpad(as_text(part), 2, "0")


def time_id(year: Column, month: Column, day: Column) -> Column:
    """``yyyyMMdd`` text; null when a part is missing."""
    return F.concat(as_text(year), pad_date_part(month), pad_date_part(day))


def time_id_to_date(value: Column) -> Column:
    """Date of a ``yyyyMMdd`` text; text that is no date gives null."""
    return F.try_to_date(value, TIME_ID_FORMAT)


def time_id_month(value: Column) -> Column:
    """Two-digit month of a ``yyyyMMdd`` text."""
    return F.substring(value, 5, 2)


def parse_iso_timestamp(value: Column) -> Column:
    """Timestamp of ISO text with milliseconds and offset; other text gives null."""
    return F.try_to_timestamp(value, F.lit(ISO_TIMESTAMP))
