"""Look-ups and labels that make report tables ready for a chart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month numbers and names.
MONTH_NAMES = {
    "01": "January",
    "02": "February",
    "03": "March",
    "04": "April",
    "05": "May",
    "06": "June",
    "07": "July",
    "08": "August",
    "09": "September",
    "10": "October",
    "11": "November",
    "12": "December",
}

# Postal abbreviations and names of the fifty states.
STATE_NAMES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def month_name(month: Column) -> Column:
    """Name of a two-digit month; a value that is no month stays as it is."""
    return F.coalesce(_lookup(MONTH_NAMES, month), month)


def state_name(abbreviation: Column) -> Column:
    """Full name of a state; null for anything else."""
    return _lookup(STATE_NAMES, abbreviation)


def currency_label(amount: Column, decimals: int = 2) -> Column:
    """``$1,234.56``, or ``$1,235`` without decimals."""
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def thousands_label(number: Column) -> Column:
    """``12,345``; a fraction is cut off, not rounded."""
    return F.format_number(F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)), 0)
