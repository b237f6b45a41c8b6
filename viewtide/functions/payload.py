"""Flatten stored payload documents; the input column holds the document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.functions import text
from viewtide.schema import CHANNEL_DOCUMENT, VIDEO_DOCUMENT


def items(docs: DataFrame, body: str, shape: str, keep: list[str] | None = None) -> DataFrame:
    """One row per entry of ``items``; documents without entries give no row."""
    parsed = F.from_json(F.col(body), shape)["items"]
    return docs.select(*(keep or []), F.explode(parsed).alias("item"))


def rejected(docs: DataFrame, body: str = "body") -> DataFrame:
    """The documents that are no valid JSON, such as those cut short, as they are; a null is one too.

    ``items`` gives no row for them, nor for documents without entries: store these rows, and count them, to tell
    the two apart.
    """
    return docs.where(F.try_parse_json(F.col(body)).isNull())


def _pick(columns: dict[str, str]) -> list[Column]:
    return [F.col(f"item.{path}").alias(name) for name, path in columns.items()]


def channel_info(docs: DataFrame, body: str = "body") -> DataFrame:
    """Nine descriptive columns per channel; four of them may be null."""
    fields = {
        "channel_id": "id",
        "name": "snippet.title",
        "customurl": "snippet.customUrl",
        "published_date": "snippet.publishedAt",
        "thumbnail_url": "snippet.thumbnails.high.url",
        "description": "brandingSettings.channel.description",
        "country": "brandingSettings.channel.country",
        "keywords": "brandingSettings.channel.keywords",
    }
    topics = F.col("item.topicDetails.topicCategories")
    return items(docs, body, CHANNEL_DOCUMENT).select(
        *_pick(fields), text.last_segments(topics).alias("topic")
    )


def channel_counters(docs: DataFrame, body: str = "body") -> DataFrame:
    """The counters of each channel, still as text."""
    fields = {
        "channel_id": "id",
        "view_count": "statistics.viewCount",
        "sub_count": "statistics.subscriberCount",
        "video_count": "statistics.videoCount",
    }
    return items(docs, body, CHANNEL_DOCUMENT).select(*_pick(fields))


def video_info(
    docs: DataFrame, body: str = "body", keep: tuple[str, ...] = ("video_type",)
) -> DataFrame:
    """Descriptive columns per video, plus the tag columns named in ``keep``."""
    fields = {
        "video_id": "id",
        "title": "snippet.title",
        "published_date": "snippet.publishedAt",
        "description": "snippet.description",
        "thumbnail_url": "snippet.thumbnails.high.url",
        "duration": "contentDetails.duration",
        "categoryid": "snippet.categoryId",
    }
    tags = F.col("item.snippet.tags")
    return items(docs, body, VIDEO_DOCUMENT, list(keep)).select(
        *keep,
        *_pick(fields),
        F.when(tags.isNotNull(), F.array_join(tags, ", ")).alias("tags"),
    )


def video_counters(docs: DataFrame, body: str = "body") -> DataFrame:
    """The counters of each video, still as text; any of them may be null."""
    fields = {
        "video_id": "id",
        "view_count": "statistics.viewCount",
        "like_count": "statistics.likeCount",
        "comment_count": "statistics.commentCount",
    }
    return items(docs, body, VIDEO_DOCUMENT).select(*_pick(fields))
