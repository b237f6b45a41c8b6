"""How many videos there are of each length, and how often they are viewed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.functions import durations
from viewtide.operators.aggregates import equal_width_bins
from viewtide.operators.dedup import latest_snapshot
from viewtide.operators.filters import aged
from viewtide.operators.quantiles import place_values, quantiles
from viewtide.session import settled


def latest_views(
    video: DataFrame, video_log: DataFrame, columns: list[str], days: int, strict: bool = False
) -> DataFrame:
    """Views of each regular video at its last snapshot, where that is late enough."""
    regular = video.where(F.col("video_type") == "video")
    latest = latest_snapshot(video_log, "video_id", ["view_count"])
    joined = latest.join(regular.select("video_id", "published_date", *columns), "video_id")
    return aged(joined, "created_date", "published_date", days, strict)


def by_minute(
    video: DataFrame, video_log: DataFrame, min_age: int = 7, more_than: int = 20
) -> DataFrame:
    """Videos under an hour by full minutes: number and mean views, for frequent lengths."""
    views = latest_views(video, video_log, ["duration"], min_age)
    part = durations.clock_parts(F.col("duration"))
    timed = views.withColumns(part).where("duration_hour = 0 and duration_minute is not null")
    return (
        timed.groupBy("duration_minute")
        .agg(F.count("*").alias("count"), F.avg("view_count").alias("avg_view_count"))
        .where(F.col("count") > more_than)
        .orderBy("duration_minute")
    )


def by_bin(
    video: DataFrame, video_log: DataFrame, min_age: int = 7, more_than: int = 20, bins: int = 20
) -> DataFrame:
    """Videos under an hour, minutes rounded up, in equal bins: number and median views."""
    views = latest_views(video, video_log, ["duration"], min_age)
    minutes = durations.whole_minutes_up(durations.clock_seconds(F.col("duration")))
    # Read three times below: for the frequent lengths, their range, and the bins.
    tally = settled(
        views.select(minutes.alias("minutes"), "view_count")
        .where("minutes between 0 and 59")
        .groupBy("minutes", "view_count")
        .agg(F.count("*").alias("videos"))
    )
    # At most 60 rows, one per minute.
    frequent = tally.groupBy("minutes").agg(F.sum("videos").alias("_n")).where(F.col("_n") > more_than)
    frequent = F.broadcast(frequent.select("minutes"))
    binned = equal_width_bins(
        tally.join(frequent, "minutes", "left_semi"), "minutes", bins, values=frequent
    )
    group = ["bin", "label"]
    placed = place_values(binned, group, "view_count", F.col("videos"))
    medians = quantiles(placed, group, "view_count", {"median_view_count": 0.5}).drop("rows")
    counts = binned.groupBy(*group).agg(F.sum("videos").alias("count"))
    # At most one row per bin.
    return counts.join(F.broadcast(medians), group, "left").orderBy("bin")
