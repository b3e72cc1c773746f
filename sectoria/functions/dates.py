"""Dates given as text, ages, months and seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last whole day that a nanosecond timestamp can hold.
FIRST_DAY = "1677-09-22"
LAST_DAY = "2262-04-11"

# Month labels in calendar order.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Season of each month number.
SEASONS = {
    "hiver": ["12", "01", "02"],
    "printemps": ["03", "04", "05"],
    "ete": ["06", "07", "08"],
    "automne": ["09", "10", "11"],
}


def lenient_date(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date, or null when the text is no date or outside the nanosecond timestamp range."""
    return plausible_date(parsed_date(text, pattern))


def parsed_date(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date, or null when the text is no date."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def plausible_date(day: Column) -> Column:
    """The date, or null when it is outside the nanosecond timestamp range; reads ``day`` several times."""
    inside = (day >= F.lit(FIRST_DAY).cast("date")) & (day <= F.lit(LAST_DAY).cast("date"))
    return F.when(inside, day)


def zero_part_flag(text: Column) -> Column:
    """``ko`` when day or month is 00 or the year is 0000, else ``ok``."""
    zero = (
        (F.substring(text, 7, 2) == "00") | (F.substring(text, 5, 2) == "00") | (F.substring(text, 1, 4) == "0000")
    )
    return F.when(zero, "ko").otherwise("ok")


def file_year_flag(text: Column, year: Column | str) -> Column:
    """``ko`` when the year differs from the year of the file (``0000`` accepts every year)."""
    year = F.lit(year) if isinstance(year, str) else year
    return F.when((F.substring(text, 1, 4) != year) & (year != "0000"), "ko").otherwise("ok")


def age_in_years(birth: Column, death: Column) -> Column:
    years = F.floor(F.datediff(death, birth) / 365).cast("int")
    return F.when(years < 0, 0).otherwise(years)


def month_label(day: Column) -> Column:
    """English month label, whatever the locale."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(day))


def season(month: Column) -> Column:
    """Season of a two-digit month text; empty for anything else."""
    label = F.lit("")
    for name, months in SEASONS.items():
        label = F.when(month.isin(months), name).otherwise(label)
    return label
