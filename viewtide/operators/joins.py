"""Joins. Spark broadcasts a side below its size limit, at run time too; nothing else is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.operators.dedup import latest_snapshot


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"):
    """Equi-join in which null keys match each other."""
    other = {key: f"_right_{key}" for key in keys}
    condition = [F.col(key).eqNullSafe(F.col(name)) for key, name in other.items()]
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def with_latest(df: DataFrame, log: DataFrame, key: str, columns: list[str], how: str = "inner"):
    """Attach columns of the last snapshot of ``key``."""
    return df.join(latest_snapshot(log, key, columns).drop("created_date"), key, how)


def star(video: DataFrame, video_log: DataFrame, channel: DataFrame, channel_log: DataFrame):
    """Every snapshot with its video, its channel name and the channel's last counters.

    Videos are described first, so that the log is shuffled once, by video.
    """
    described = (
        video.select("video_id", "channel_id", "video_type", "published_date")
        .join(channel.select("channel_id", "name"), "channel_id", "left")
        .transform(with_latest, channel_log, "channel_id", ["sub_count"], "left")
    )
    return video_log.join(described, "video_id")


def not_stored(found: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``found`` whose key is not stored yet; repeats in ``found`` stay."""
    return found.join(stored.select(*keys), keys, "left_anti")


def with_group_count(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """Attach the number of rows of the group."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(name)), keys)
