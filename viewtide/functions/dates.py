"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def calendar_parts(date: Column) -> dict[str, Column]:
    """Parts of a date; weeks are ISO weeks and Sunday is day 1."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "day_of_week": F.dayofweek(date),
        "quarter": F.quarter(date),
        "day_of_year": F.dayofyear(date),
        "is_weekend": F.dayofweek(date).isin(1, 7),
    }


def epoch_to_date(seconds: Column) -> Column:
    """Date of a Unix time, in the session time zone."""
    return F.to_date(F.timestamp_seconds(seconds))


def parse_date(text: Column) -> Column:
    """Date at the start of the text, null where it is not one."""
    return F.to_date(parse_timestamp(text))


def parse_timestamp(text: Column) -> Column:
    """Timestamp from ISO-like text, null where it is not one."""
    return F.try_to_timestamp(text)


def local_timestamp(utc_text: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a time such as ``2024-02-20T15:00:01Z``.

    The result has no time zone and does not depend on that of the session.
    """
    return F.convert_timezone(None, F.lit(zone), parse_timestamp(utc_text))


def clock_time(timestamp: Column) -> Column:
    """Time of day as ``HH:mm:ss``."""
    return F.date_format(timestamp, "HH:mm:ss")


def age_in_days(snapshot: Column, published: Column) -> Column:
    return F.datediff(snapshot, published)


def previous_month_start(date: Column) -> Column:
    return F.add_months(F.trunc(date, "month"), -1).cast("date")


def previous_month_end(date: Column) -> Column:
    return F.date_sub(F.trunc(date, "month"), 1)


def month_checkpoints(first_day: Column) -> Column:
    """Days 1, 7, 13, 19 and 25 of the month starting at ``first_day``, as an array."""
    return F.sequence(first_day, F.date_add(first_day, 24), F.expr("interval 6 days"))


def month_before(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the month before ``as_of``, to be used as literals."""
    last = as_of.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def checkpoint_days(first_day: dt.date) -> list[dt.date]:
    """The days of ``month_checkpoints`` as literals, which prune partitions."""
    return [first_day + dt.timedelta(days=offset) for offset in (0, 6, 12, 18, 24)]
