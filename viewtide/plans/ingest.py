"""From stored listings and payload documents to table rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.functions import dates, durations, payload
from viewtide.operators.columns import cast_counters, nan_to_null
from viewtide.operators.dedup import first_per_key
from viewtide.operators.filters import expired
from viewtide.operators.joins import not_stored
from viewtide.sources.writers import updated

ZONE = "Asia/Taipei"


def typed_videos(info: DataFrame, zone: str = ZONE) -> DataFrame:
    """Local publishing date and time, and clock text for the ISO duration."""
    local = dates.local_timestamp(F.col("published_date"), zone)
    return info.withColumns(
        {
            "published_time": local,
            "published_date": F.to_date(local),
            "duration": durations.clock_text(durations.iso_seconds(F.col("duration"))),
            "categoryid": F.col("categoryid").try_cast("smallint"),
        }
    )


def new_videos(
    listing: DataFrame, stored: DataFrame, documents: DataFrame, zone: str = ZONE
) -> DataFrame:
    """Rows for the listed videos that are not stored yet.

    ``listing`` has (channel_id, video_type, video_id) and its page order,
    ``documents`` has (video_id, body). A video is taken once, from its first
    place in the listing.
    """
    found = not_stored(listing, stored, ["channel_id", "video_type", "video_id"])
    wanted = first_per_key(found, ["video_id"], ["page_no", "pos"])
    wanted = wanted.select("video_id", "channel_id", "video_type")
    described = wanted.join(documents.select("video_id", "body"), "video_id")
    info = payload.video_info(described, keep=("channel_id", "video_type"))
    return typed_videos(first_per_key(info, ["video_id"], ["channel_id", "video_type"]), zone)


def _stamped(counters: DataFrame, columns: list[str], day: dt.date | Column) -> DataFrame:
    day = day if isinstance(day, Column) else F.lit(day)
    return cast_counters(counters, columns).withColumn("created_date", day)


def channel_snapshot(documents: DataFrame, day: dt.date | Column) -> DataFrame:
    """One row of counters per channel document."""
    columns = ["view_count", "sub_count", "video_count"]
    return _stamped(payload.channel_counters(documents), columns, day)


def video_snapshot(video: DataFrame, documents: DataFrame, day: dt.date | Column) -> DataFrame:
    """One row of counters per active video; hidden counters are null."""
    active = video.where("active").select("video_id")
    counters = payload.video_counters(documents.join(active, "video_id", "left_semi"))
    return nan_to_null(_stamped(counters, ["view_count", "like_count", "comment_count"], day))


def registered_channels(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """Channel rows for the listed ids that have a document."""
    wanted = ids.select("channel_id").distinct()
    return payload.channel_info(documents.join(wanted, "channel_id", "left_semi"))


def expire_videos(video: DataFrame, as_of: dt.date, days: int = 30, counted=None) -> DataFrame:
    """Videos published more than ``days`` before ``as_of`` are no longer active."""
    old = expired(F.col("published_date"), F.col("active"), F.lit(as_of), days)
    return updated(video, F.coalesce(old, F.lit(False)), {"active": F.lit(False)}, counted)


def activate_channels(channel: DataFrame, counted=None) -> DataFrame:
    """All channels are due to be crawled."""
    return updated(channel, F.lit(True), {"active": F.lit(True)}, counted)


def deactivate_channels(channel: DataFrame, done: DataFrame, counted=None) -> DataFrame:
    """The channels that were crawled are no longer due."""
    marks = done.select("channel_id").distinct().withColumn("_done", F.lit(True))
    marked = channel.join(marks, "channel_id", "left")
    cleared = updated(marked, F.col("_done").isNotNull(), {"active": F.lit(False)}, counted)
    return cleared.drop("_done")
