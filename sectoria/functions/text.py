"""Text cleaning, codes and coordinates in text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms in each kind of place name.
MAIN_PLACES = ("éèêîïôö", "eeeiioo")
OVERSEAS_PLACES = ("éèêîï", "eeeii")
COUNTRY_NAMES = ("éèêîïÎâ", "eeeiiia")


def pad_code(code: Column, width: int) -> Column:
    """Left-pad with zeros, never truncate; a leading sign stays in front."""
    signed = F.substring(code, 1, 1).isin("+", "-")
    padded = F.when(
        signed, F.concat(F.substring(code, 1, 1), F.lpad(F.substr(code, F.lit(2)), width - 1, "0"))
    ).otherwise(F.lpad(code, width, "0"))
    return F.when(F.length(code) < width, padded).otherwise(code)


def strip_decimal_suffix(code: Column) -> Column:
    """Remove the literal ``.0`` a numeric read leaves in a code."""
    return F.replace(code, F.lit(".0"), F.lit(""))


def fold_accents(text: Column, letters: tuple[str, str] = MAIN_PLACES) -> Column:
    return F.translate(text, *letters)


def parenthesised_year(text: Column) -> Column:
    """First four-digit year in parentheses, null if there is none."""
    return F.nullif(F.regexp_extract(text, r"\((\d{4})\)", 1), F.lit(""))


def drop_parentheses(text: Column) -> Column:
    return F.regexp_replace(text, r"\s*\([^)]*\)", "")


def first_word(text: Column) -> Column:
    return F.substring_index(F.trim(text), " ", 1)


def dms_to_degrees(dms: Column, digits: int | None = 4, legacy_sign: bool = False) -> Column:
    """``dd:mm:ss`` to decimal degrees.

    The sign of the degrees applies to minutes and seconds too;
    ``legacy_sign=True`` adds them unsigned instead.
    """
    from .numeric import round_even

    parts = F.split(dms, ":")
    degrees = parts[0].try_cast("double")
    fraction = parts[1].try_cast("double") / 60 + parts[2].try_cast("double") / 3600
    if legacy_sign:
        value = degrees + fraction
    else:
        value = F.when(F.trim(parts[0]).startswith("-"), degrees - fraction).otherwise(degrees + fraction)
    return value if digits is None else round_even(value, digits)


def clock_label(day_fraction: Column) -> Column:
    """Fraction of a day as ``HhM`` text, without padding."""
    hours = day_fraction * 24
    minutes = (hours - clock_hour(day_fraction)) * 60
    return F.concat(clock_hour(day_fraction).cast("string"), F.lit("h"), minutes.cast("int").cast("string"))


def clock_hour(day_fraction: Column) -> Column:
    return (day_fraction * 24).cast("int")


def group_thousands(value: Column) -> Column:
    """Whole number with a space between thousands; half to even."""
    return F.translate(F.format_number(F.rint(value).cast("bigint"), 0), ",", " ")


def agglomeration(city: Column, names: tuple[str, ...] = ("PARIS", "LYON", "MARSEILLE")) -> Column:
    """Name of the agglomeration a numbered district belongs to; other cities stay."""
    is_part = F.lit(False)
    for name in names:
        is_part = is_part | city.startswith(name)
    return F.when(is_part, F.split(F.trim(city), r"\s+")[0]).otherwise(city)
