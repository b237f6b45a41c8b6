"""The daily run: new videos, channel counters and video counters appended to the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from viewtide import schema
from viewtide.functions import payload
from viewtide.operators.dedup import latest_per_key
from viewtide.operators.filters import expired
from viewtide.operators.joins import not_stored
from viewtide.plans import ingest, pages
from viewtide.session import settled
from viewtide.sources import writers
from viewtide.streaming.snapshots import append_new_days


def append_new_videos(
    spark: SparkSession,
    listing_pages: DataFrame,
    documents: DataFrame,
    video_path: str,
    checkpoint_path: str | None = None,
    limit: int = 20,
) -> int:
    """Append the videos that are listed but not stored, and return how many.

    The rows are settled first, as they are derived from the table they go to.
    ``checkpoint_path`` gets them as CSV, laid out by channel.
    """
    stored = spark.read.schema(schema.VIDEO).parquet(video_path)
    new = ingest.new_videos(pages.listing(listing_pages, limit), stored, documents)
    new = settled(new.withColumn("active", F.lit(True)))
    if checkpoint_path:
        writers.write_by_key(new, checkpoint_path, "channel_id", csv=True)
    return writers.append(new, video_path, schema.VIDEO, {"created_at": F.current_timestamp()})


def keep_rejected(documents: DataFrame, day: dt.date, path: str) -> int:
    """Store the documents that are no valid JSON, by day, and return how many. Of a day that is run again one set is kept."""
    counted = Observation()
    rows = payload.rejected(documents).withColumn("rejected_on", F.lit(day)).observe(counted, F.count("*").alias("rows"))
    writer = rows.write.partitionBy("rejected_on").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return writers.observed_rows(counted)


def append_channel_counters(documents: DataFrame, day: dt.date, log_path: str, rejected_path: str | None = None) -> int:
    """Append one row of counters per channel document, once a day, and return how many.

    ``rejected_path`` gets the documents that cannot be read.
    """
    if rejected_path:
        keep_rejected(documents, day, rejected_path)
    rows = ingest.channel_snapshot(documents, day)
    return append_new_days(_log_rows(rows, schema.CHANNEL_LOG), log_path, "channel_id")


def append_video_counters(
    video: DataFrame, documents: DataFrame, day: dt.date, log_path: str, rejected_path: str | None = None
) -> int:
    """Append one row of counters per active video that has a document, once a day, as for channels."""
    if rejected_path:
        keep_rejected(documents, day, rejected_path)
    rows = ingest.video_snapshot(video, documents, day)
    return append_new_days(_log_rows(rows, schema.VIDEO_LOG), log_path, "video_id")


def register_channels(ids: DataFrame, documents: DataFrame, channel_path: str) -> int:
    """Append the channels of an id list that have a document and are not stored, and return how many.

    A second run adds nothing. Of several documents of a channel one is stored.
    """
    rows = ingest.registered_channels(ids, documents).withColumn("active", F.lit(True))
    rows = rows.withColumn("published_date", F.try_to_timestamp("published_date"))
    rows = latest_per_key(rows, ["channel_id"], ["published_date"])
    # An empty append creates the folder, so that the first run can read it.
    writers.append(rows.limit(0), channel_path, schema.CHANNEL)
    stored = ids.sparkSession.read.schema(schema.CHANNEL).parquet(channel_path)
    # Settled, as the rows are derived from the table they go to.
    rows = settled(not_stored(rows, stored, ["channel_id"]))
    return writers.append(rows, channel_path, schema.CHANNEL, {"created_at": F.current_timestamp()})


def expire(spark: SparkSession, video_table: str, folder: str, as_of: dt.date, days: int = 30) -> int:
    """Store that videos older than ``days`` are no longer active, and return how many changed."""
    return writers.update_table(
        spark, video_table, folder, lambda video, counted: ingest.expire_videos(video, as_of, days, counted)
    )


def expire_partitioned(spark: SparkSession, video_path: str, as_of: dt.date, days: int = 30) -> int:
    """``expire`` for a video table laid out by ``published_date``: days without active old videos are not touched."""
    old = expired(F.col("published_date"), F.col("active"), F.lit(as_of), days)
    return writers.update_partitions(spark, video_path, "published_date", old, {"active": F.lit(False)})


def set_marks(spark: SparkSession, channel_table: str, folder: str) -> int:
    """At the start of a run: all channels are due."""
    return writers.update_table(spark, channel_table, folder, ingest.activate_channels)


def clear_marks(spark: SparkSession, channel_table: str, folder: str, done: DataFrame) -> int:
    """The channels of ``done`` were crawled. A run that is broken off goes on with the rest."""
    return writers.update_table(
        spark, channel_table, folder, lambda channel, counted: ingest.deactivate_channels(channel, done, counted)
    )


def crawl(
    spark: SparkSession,
    channel_table: str,
    folder: str,
    listing_pages: DataFrame,
    documents: DataFrame,
    video_path: str,
    limit: int = 20,
) -> int:
    """Append the new videos of the channels that are due, clear their marks, and return how many videos there were.

    Where no channel is due, a new round begins and all are. A run that is broken off before the marks are cleared finds
    the same channels due again, and their videos stored or not, so that nothing is appended twice.
    """
    if spark.table(channel_table).where("active").isEmpty():
        set_marks(spark, channel_table, folder)
    due = settled(spark.table(channel_table).where("active").select("channel_id"))
    theirs = listing_pages.join(due, "channel_id", "left_semi")
    count = append_new_videos(spark, theirs, documents, video_path, limit=limit)
    clear_marks(spark, channel_table, folder, due)
    return count


def _log_rows(rows: DataFrame, table: T.StructType) -> DataFrame:
    return writers.align(rows, table, {**schema.LOG_DEFAULTS, "created_at": F.current_timestamp()})
