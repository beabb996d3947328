"""Dates, ages and spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draws import draw32
from .nulls import as_col, as_value

DAYS_PER_YEAR = 365.25


def years_between(start: Column | str, end: Column) -> Column:
    """Exact years from `start` to `end`, a year being 365.25 days."""
    return F.datediff(end, as_col(start)) / F.lit(DAYS_PER_YEAR)


def drawn_day(year: Column, month: Column, seed, *keys: Column | str) -> Column:
    """A date in the given year and month; the day, 1 to 28, is drawn per row key."""
    day = F.lit(1) + F.floor(draw32(seed, *keys) * F.lit(28) / F.lit(4294967296.0)).cast("int")
    return F.make_date(year.cast("int"), month.cast("int"), day)


def span_words(this_year: Column, start_year: Column | str) -> Column:
    """Time since a start year in words. A negative or missing start year is "Unknown"."""
    start = as_col(start_year)
    years = (this_year - start).cast("int")
    return (
        F.when(start.isNull() | (start < 0), "Unknown")
        .when(years == -1, "Unknown")
        .when(years == 0, "Less than a year")
        .otherwise(F.concat(years.cast("string"), F.lit(" to "), (years + 1).cast("string"), F.lit(" years")))
    )


def covers(start: Column | str, end: Column | str, day) -> Column:
    """True for an interval, closed at both ends, that holds the day."""
    day = as_value(day)
    return (as_col(start) <= day) & (as_col(end) >= day)
