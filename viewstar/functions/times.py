"""Dates and times of an event. Times carry no zone, so no session setting moves them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A date key has four digits for the year.
LAST_YEAR = 9999


def date_text(local_time) -> Column:
    """The first ten characters of the event's time."""
    return F.substring(local_time, 1, 10)


def event_date(local_time) -> Column:
    """Date of the event; null where the text holds none that a date key can express."""
    date = date_text(local_time).try_cast("date")
    return F.when(F.year(date).between(1, LAST_YEAR), date)


def event_time(local_time) -> Column:
    """Zone-free timestamp of the event; null where the text holds none."""
    text = F.col(local_time) if isinstance(local_time, str) else local_time
    return F.replace(text, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def epoch_seconds(time) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    return F.unix_timestamp(time)


def date_key(date) -> Column:
    """The date as an integer in the form yyyyMMdd; null for years outside 1 to 9999."""
    date = F.col(date) if isinstance(date, str) else date
    key = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return F.when(F.year(date).between(1, LAST_YEAR), key.cast("int"))


def calendar(date) -> dict[str, Column]:
    """Calendar attributes of a date. Weeks are ISO weeks; Sunday is day 1."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.dayofweek(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
    }
