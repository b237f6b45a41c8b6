"""Canonical tables, their declared constraints, and the payload document shapes."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "long": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs, without the session that parsing DDL text needs."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


CHANNEL = _table(
    "channel_id string, name string, customurl string, published_date timestamp,"
    " thumbnail_url string, description string, country string, keywords string,"
    " topic string, created_at timestamp, active boolean"
)
VIDEO = _table(
    "video_id string, channel_id string, title string, video_type string,"
    " published_date date, published_time timestamp, duration string,"
    " thumbnail_url string, description string, tags string, categoryid smallint,"
    " created_at timestamp, active boolean"
)
VIDEO_LOG = _table(
    "video_id string, view_count long, like_count long, comment_count long,"
    " created_date date, created_at timestamp"
)
CHANNEL_LOG = _table(
    "channel_id string, view_count long, sub_count long, video_count long,"
    " created_at timestamp, created_date date"
)
STATUS_CODE = _table("status_id smallint, name string")

TABLES = {
    "channel": CHANNEL,
    "video": VIDEO,
    "video_log": VIDEO_LOG,
    "channel_log": CHANNEL_LOG,
    "status_code": STATUS_CODE,
}

# The declared constraints of each table. "exact" and "longest"
# are character counts, "allowed" a closed set, "refers" a foreign key.
CONSTRAINTS = {
    "channel": {
        "primary": ["channel_id"],
        "unique": ["customurl", "thumbnail_url"],
        "required": ["name", "published_date"],
        "exact": {"channel_id": 24, "country": 2},
    },
    "video": {
        "primary": ["video_id"],
        "unique": ["thumbnail_url"],
        "required": ["title", "published_date", "categoryid", "duration"],
        "exact": {"video_id": 11},
        "longest": {"duration": 20},
        "allowed": {"video_type": ["video", "short"]},
    },
    "video_log": {
        "required": ["view_count", "like_count", "comment_count"],
        "refers": {"video_id": ("video", "video_id")},
    },
    "channel_log": {
        "required": ["view_count", "sub_count", "video_count"],
        "refers": {"channel_id": ("channel", "channel_id")},
    },
    "status_code": {
        "primary": ["status_id"],
        "unique": ["name"],
        "required": ["name"],
        "longest": {"name": 20},
        "allowed": {"status_id": [0, 1, 2]},
    },
}

# What a counter column holds when an appended row leaves it out.
LOG_DEFAULTS = {
    "view_count": 0,
    "like_count": 0,
    "comment_count": 0,
    "sub_count": 0,
    "video_count": 0,
}

# Payload documents, reduced to the keys that are read. A key that a document
# lacks comes out as null.
CHANNEL_DOCUMENT = """
items array<struct<
  id: string,
  snippet: struct<
    title: string, customUrl: string, publishedAt: string,
    thumbnails: struct<high: struct<url: string>>>,
  statistics: struct<viewCount: string, subscriberCount: string, videoCount: string>,
  topicDetails: struct<topicCategories: array<string>>,
  brandingSettings: struct<
    channel: struct<description: string, keywords: string, country: string>>>>
"""
VIDEO_DOCUMENT = """
items array<struct<
  id: string,
  snippet: struct<
    publishedAt: string, channelId: string, title: string, description: string,
    thumbnails: struct<high: struct<url: string>>,
    tags: array<string>, categoryId: string>,
  contentDetails: struct<duration: string>,
  statistics: struct<viewCount: string, likeCount: string, commentCount: string>>>
"""
