"""Parsing, labels and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date of a text; null if the text does not fit the pattern."""
    return F.try_to_date(text, pattern)


def to_number(value: Column) -> Column:
    """Double of a text; null if it is not a number."""
    return value.try_cast("double")


def parse_flag(text: Column) -> Column:
    """True / False of the spellings the dialects use (True, 1, 1.0 ...)."""
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin("true", "1", "1.0"), True).when(word.isin("false", "0", "0.0"), False)


def normalize_postal(code: Column) -> Column:
    """Eight digits, or null when the code does not hold exactly eight."""
    digits = F.regexp_replace(code.cast("string"), "[^0-9]", "")
    return F.when(F.length(digits) == 8, digits)


def postal_from_number(code: Column) -> Column:
    """Postal text of a code once read as a number, leading zeros restored."""
    return F.lpad(code.cast("long").cast("string"), 8, "0")


def format_postal(code: Column) -> Column:
    """Display form 00000-000."""
    digits = normalize_postal(code)
    return F.concat(F.substring(digits, 1, 5), F.lit("-"), F.substring(digits, 6, 3))


def client_label(client_id: Column) -> Column:
    return F.concat(F.lit("Cliente "), client_id.cast("string"))


def city_label(city: Column, state: Column) -> Column:
    """``city - state``; null if either is unknown."""
    return F.concat(city, F.lit(" - "), state)


def channel_name(is_b2b: Column) -> Column:
    """B2B or B2C; null for an unknown flag."""
    return F.when(is_b2b, "B2B").when(~is_b2b, "B2C")


def volume_units(hectolitres: Column) -> list[Column]:
    """The volume in litres and in cubic metres."""
    hl = hectolitres.cast("double")
    return [(hl * 100.0).alias("volume_l"), (hl / 10.0).alias("volume_m3")]
