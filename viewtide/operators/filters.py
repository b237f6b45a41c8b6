"""Row filters that need more than one expression."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.functions import dates, durations


def on_days(df: DataFrame, column: str, days: list[dt.date]) -> DataFrame:
    """Rows of the listed days; prunes partitions of a table laid out by day."""
    return df.where(F.col(column).isin(days))


def not_listed(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows whose value is not in the list. A null is neither in nor out and is dropped."""
    return df.where(~F.col(column).isin(names))


def aged(df: DataFrame, snapshot: str, published: str, days: int, strict: bool = False) -> DataFrame:
    """Rows whose snapshot is at least (``strict``: more than) ``days`` after publishing."""
    age = dates.age_in_days(F.col(snapshot), F.col(published))
    return df.where(age > days if strict else age >= days)


def expired(published: Column, active: Column, as_of: Column, days: int = 30) -> Column:
    """Whether a row is active although published more than ``days`` before ``as_of``."""
    return active & (published < F.date_sub(as_of, days))


def under_an_hour(df: DataFrame, clock: str) -> DataFrame:
    """Rows whose hour part is zero."""
    return df.where(durations.clock_parts(F.col(clock))["duration_hour"] == 0)


def with_min_count(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Rows of the groups holding more than ``more_than`` rows.

    Counting by aggregation rather than over a window keeps a huge group from
    being gathered in one task.
    """
    frequent = df.groupBy(*keys).count().where(F.col("count") > more_than)
    return df.join(frequent.select(*keys), keys, "left_semi")


def in_top_set(df: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in a computed set."""
    return df.join(top.select(*keys), keys, "left_semi")


def of_latest_day(log: DataFrame, day: str = "created_date") -> DataFrame:
    """Rows of the last day found anywhere in the log."""
    return log.where(F.col(day) == log.agg(F.max(day)).scalar())
