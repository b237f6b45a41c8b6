"""Views per subscriber: the leading channels and the spread among their videos."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from viewtide.functions.ratios import ratio
from viewtide.operators.filters import not_listed
from viewtide.operators.joins import with_latest
from viewtide.operators.quantiles import place_values, quantiles
from viewtide.plans.duration_trend import latest_views
from viewtide.session import settled

# Names that the analysis leaves out of its ranking; callers pass them where they want that.
EXCLUDED = ["周杰倫 Jay Chou", "凱文羊", "福茂唱片"]


def subscribers(channel: DataFrame, channel_log: DataFrame) -> DataFrame:
    """Name and last number of subscribers of each channel that has a name."""
    named = channel.select("channel_id", "name").where("name is not null")
    return with_latest(named, channel_log, "channel_id", ["sub_count"], "left")


def old_views(video: DataFrame, video_log: DataFrame, min_age: int = 30) -> DataFrame:
    """Views of each regular video older than ``min_age`` days, with its channel."""
    return latest_views(video, video_log, ["channel_id"], min_age, strict=True)


def video_ratios(views: DataFrame, subs: DataFrame) -> DataFrame:
    """Views per subscriber of each video, from ``old_views`` and ``subscribers``."""
    joined = views.join(subs, "channel_id")
    return joined.withColumn("view_sub_ratio", ratio(F.col("view_count"), F.col("sub_count")))


def top_channels(
    views: DataFrame, subs: DataFrame, excluded: Sequence[str] = (), count: int = 10
) -> DataFrame:
    """The names with the highest mean ratio and their mean number of subscribers.

    A channel's videos share one divisor, so views are summed per channel before
    the join: a channel with very many videos joins as one row.
    """
    summed = views.groupBy("channel_id").agg(
        F.sum("view_count").alias("views"),
        F.count("view_count").alias("viewed"),
        F.count("*").alias("videos"),
    )
    channels = summed.join(not_listed(subs, "name", list(excluded)), "channel_id")
    rated = F.when(F.col("sub_count") != 0, F.col("viewed"))
    counted = F.when(F.col("sub_count").isNotNull(), F.col("videos"))
    mean_ratio = F.try_divide(F.sum(ratio(F.col("views"), F.col("sub_count"))), F.sum(rated))
    mean_subs = F.try_divide(F.sum(F.col("sub_count") * F.col("videos")), F.sum(counted))
    means = channels.groupBy("name").agg(
        mean_ratio.alias("avg_view_sub_ratio"), mean_subs.alias("sub_count")
    )
    return means.orderBy(F.desc("avg_view_sub_ratio"), "name").limit(count)


def ratio_spread(
    views: DataFrame, subs: DataFrame, excluded: Sequence[str] = (), count: int = 10
) -> DataFrame:
    """Box-plot figures for the leading channels, in their order.

    Quartiles are interpolated linearly; whiskers end at the last value within
    1.5 interquartile ranges of the box.
    """
    views, subs = settled(views.select("channel_id", "view_count")), settled(subs)
    # At most ``count`` rows, as are the tables made from it by name.
    top = settled(top_channels(views, subs, excluded, count))
    chosen = subs.join(F.broadcast(top.select("name")), "name", "left_semi")
    ratios = video_ratios(views, chosen)
    placed = place_values(ratios, ["name"], "view_sub_ratio")
    points = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "highest": 1.0}
    box = quantiles(placed, ["name"], "view_sub_ratio", points)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col("view_sub_ratio")
    inside = F.when(value.between(F.col("q1") - reach, F.col("q3") + reach), value)
    whiskers = (
        placed.join(F.broadcast(box), "name")
        .groupBy("name")
        .agg(F.min(inside).alias("lower_whisker"), F.max(inside).alias("upper_whisker"))
    )
    figures = F.broadcast(box.join(F.broadcast(whiskers), "name", "left"))
    return top.join(figures, "name", "left").orderBy(F.desc("avg_view_sub_ratio"), "name")
