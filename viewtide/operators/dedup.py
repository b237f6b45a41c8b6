"""One row per key.

The ``row_number() = 1`` filter makes Spark keep one row per key and input
task before the shuffle, so a key holding most of the rows costs no more
than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_rows(df: DataFrame, keys: list[str], order: list[Column], limit: int = 1) -> DataFrame:
    """The first ``limit`` rows per key. ``order`` should end in a unique column."""
    if not order and limit == 1:
        return df.dropDuplicates(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key; all other columns break ties, so the result is always the same."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return first_rows(df, keys, [F.desc(c) for c in [*order, *rest]])


def snapshot_order(log: DataFrame) -> list[str]:
    """By day, then by the time of writing where the log has one."""
    return [c for c in ("created_date", "created_at") if c in log.columns]


def latest_snapshot(log: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of the last snapshot of each key, with its day."""
    order = snapshot_order(log)
    latest = latest_per_key(log.select(key, *columns, *order), [key], order)
    return latest.select(key, *columns, "created_date")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key, ties broken by all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return first_rows(df, keys, [F.asc(c) for c in [*order, *rest]])
