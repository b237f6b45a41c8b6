"""Time and channel dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewtide.functions.dates import calendar_parts

# The calendar the warehouse covers.
FIRST_DAY = dt.date(2024, 4, 1)
LAST_DAY = dt.date(2030, 12, 31)


def time_dimension(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """One row per day with its calendar parts."""
    span = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _calendar(span)


def time_dimension_of(df: DataFrame, date: str) -> DataFrame:
    """The calendar from the first to the last day found in a column."""
    day = F.to_date(date)
    return _calendar(df.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def _calendar(span: DataFrame) -> DataFrame:
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    return days.withColumns(calendar_parts(F.col("date")))


def channel_dimension(channel: DataFrame) -> DataFrame:
    return channel.select(
        "channel_id", "name", "customurl", "published_date", "country", "keywords", "topic"
    )
