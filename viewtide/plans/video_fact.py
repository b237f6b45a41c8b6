"""One row per video: metadata, its first snapshots side by side, rank and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.functions import durations, ratios
from viewtide.operators.aggregates import side_by_side
from viewtide.operators.dedup import snapshot_order
from viewtide.operators.joins import with_latest
from viewtide.operators.positions import number_rows
from viewtide.operators.windows import first_snapshots
from viewtide.session import settled

SNAPSHOT = {
    "created_date": "date",
    "view_count": "view",
    "comment_count": "comment",
    "like_count": "like",
}


def video_details(video: DataFrame) -> DataFrame:
    """Videos with the length in minutes and the hour of publishing."""
    return video.select(
        "video_id", "title", "channel_id", "video_type", "published_time",
        durations.clock_minutes(F.col("duration")).alias("duration"),
        F.hour("published_time").alias("published_hour"),
    )


def snapshots_wide(video_log: DataFrame, snapshots: int = 30) -> DataFrame:
    """``1_date, 1_view, 1_comment, 1_like, 2_date ...``: the n-th snapshot, not the n-th day."""
    written = [c for c in snapshot_order(video_log) if c not in SNAPSHOT]
    log = video_log.select("video_id", *SNAPSHOT, *written)
    numbered = first_snapshots(log, "video_id", snapshots)
    return side_by_side(numbered, "video_id", "ordinal", snapshots, SNAPSHOT)


def video_fact(
    video: DataFrame,
    video_log: DataFrame,
    channel_log: DataFrame,
    snapshots: int = 30,
    average_days: int = 6,
    descending: bool = False,
) -> DataFrame:
    """Join everything known per video and rank it by the views at the last snapshot counted.

    Ranks are per channel and video type, ascending unless ``descending``: the
    least viewed video is number 1 and videos with fewer snapshots come first.
    """
    wide = settled(
        video_details(video)
        .drop("published_hour")
        # By channel while rows are narrow; the wide ones are shuffled by video only.
        .transform(with_latest, channel_log, "channel_id", ["sub_count"])
        .join(snapshots_wide(video_log, snapshots), "video_id")
    )
    views = F.col(f"{snapshots}_view")
    order = [F.col("views").desc() if descending else F.col("views").asc(), F.asc("video_id")]
    # Ranked on four columns and joined back, as the rows are wide.
    group = ["channel_id", "video_type"]
    narrow = wide.select("video_id", *group, views.alias("views"))
    places = number_rows(narrow, group, order, "video_ranking").select("video_id", "video_ranking")
    ranked = wide.join(places, "video_id")
    return ranked.withColumns(
        {
            "avg_daily_view": ratios.int_ratio(views, F.lit(average_days)),
            "sub_view_ratio": ratios.int_ratio(views, F.col("sub_count")),
        }
    ).orderBy("published_time", "video_id")
