"""Latest counters per channel with one topic label each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from viewtide.operators.columns import drop_incomplete, fill_text
from viewtide.operators.dedup import latest_per_key, snapshot_order
from viewtide.operators.topk import top_topics, with_category
from viewtide.session import settled


def latest_channels(channel: DataFrame, channel_log: DataFrame, nulls: str = "drop") -> DataFrame:
    """The last snapshot of each channel with its name and topic.

    ``nulls="drop"`` ignores snapshots with any null and keeps one row per
    channel; ``"fill"`` writes ``NULL`` for missing text, keeps channels that are
    only in the log, and keeps one row per name.
    """
    named, order = channel.select("channel_id", "name", "topic"), snapshot_order(channel_log)
    if nulls == "drop":
        latest = latest_per_key(drop_incomplete(channel_log), ["channel_id"], order)
        return latest.join(drop_incomplete(named), "channel_id")
    latest = latest_per_key(channel_log, ["channel_id"], order)
    filled = fill_text(latest.join(named, "channel_id", "left"))
    return latest_per_key(filled, ["name"], order)


def channel_distribution(
    channel: DataFrame, channel_log: DataFrame, nulls: str = "drop", labels: int = 7
) -> DataFrame:
    """Latest channels, their topic replaced by the first frequent label it contains."""
    latest = settled(latest_channels(channel, channel_log, nulls))
    return with_category(latest, "topic", top_topics(latest, "topic", labels), "topic")
