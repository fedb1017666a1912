"""Dates and times written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How submission times are written.
SUBMIT_FORMATS = ("yyyy-M-d H:m", "yyyy-M-d H:m:s")
DATE_FORMAT = "yyyy-M-d"


def submit_time(text: Column) -> Column:
    """Submission time, null if it fits neither form."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in SUBMIT_FORMATS))


def day(text: Column, fmt: str = DATE_FORMAT) -> Column:
    """Date, null if malformed."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def fiscal_year(text: Column) -> Column:
    """Year of a date that starts with ``YYYY-MM-DD`` or ``YYYY/MM/DD``."""
    year = F.regexp_extract(text, r"^([0-9]{4})[-/][0-9]{2}[-/][0-9]{2}", 1)
    return F.nullif(year, F.lit("")).cast("int")


def one_year_later(before: Column, after: Column) -> Column:
    """Same month and day, next year. 29 February has no such day a year later."""
    return (
        (F.year(before) + 1 == F.year(after))
        & (F.month(before) == F.month(after))
        & (F.dayofmonth(before) == F.dayofmonth(after))
    )


def one_year_later_day(before: Column) -> Column:
    """The day exactly one year later, or null for 29 February: an equality join key."""
    return F.when(
        ~((F.month(before) == 2) & (F.dayofmonth(before) == 29)), F.add_months(before, 12)
    )
