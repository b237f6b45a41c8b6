"""Durations: clock text (``HH:MM:SS``) and ISO-8601 text (``PT1H6M40S``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: weeks, days, hours, minutes and seconds of an ISO-8601 duration.
# Years and months have no fixed length and make the result null.
ISO_DURATION = r"^P(?=.*\d)(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.\d+)?S)?)?$"
ISO_UNIT_SECONDS = (604800, 86400, 3600, 60, 1)


def clock_parts(clock: Column) -> dict[str, Column]:
    """Hour, minute and second; a part that is missing or not a number is null.

    Days in front, as in ``1 day 02:03:04``, count as 24 hours each.
    """
    parts = F.split(clock, ":")
    words = F.split(F.get(parts, F.lit(0)), " ")
    unit = F.get(words, F.lit(1))
    days = F.when(unit.isNull(), 0).when(unit.isin("day", "days"), F.get(words, F.lit(0)).try_cast("int"))
    return {
        "duration_hour": F.element_at(words, -1).try_cast("int") + days * 24,
        "duration_minute": F.get(parts, F.lit(1)).try_cast("int"),
        "duration_second": F.get(parts, F.lit(2)).try_cast("int"),
    }


def clock_seconds(clock: Column) -> Column:
    part = clock_parts(clock)
    return part["duration_hour"] * 3600 + part["duration_minute"] * 60 + part["duration_second"]


def clock_minutes(clock: Column) -> Column:
    """Length in minutes as a double."""
    return clock_seconds(clock) / 60


def whole_minutes_up(seconds: Column) -> Column:
    """Length in minutes, rounded up."""
    return F.ceil(seconds / 60).cast("int")


def iso_seconds(text: Column) -> Column:
    """Whole seconds of an ISO-8601 duration, null where the text is not one.

    One replacement brings all units into fixed places, where the pattern would
    otherwise be matched once per unit.
    """
    placed = F.regexp_replace(text, ISO_DURATION, "0$1:0$2:0$3:0$4:0$5")
    amounts = F.split(F.when(placed != text, placed), ":")
    total = F.lit(0).cast("long")
    for place, seconds in enumerate(ISO_UNIT_SECONDS):
        total = total + F.get(amounts, F.lit(place)).try_cast("long") * seconds
    return total


def iso_interval(text: Column) -> Column:
    """The ISO-8601 duration as a day-time interval."""
    return F.make_dt_interval(secs=iso_seconds(text))


def clock_text(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS``; hours may pass 24."""
    parts = [F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60]
    return F.when(seconds.isNotNull(), F.format_string("%02d:%02d:%02d", *parts))
