"""Topics and capped lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.functions import text
from viewtide.operators.dedup import first_rows


def topic_counts(df: DataFrame, topic: str = "topic") -> DataFrame:
    """How often each single topic occurs in a multi-valued column."""
    tokens = df.select(F.explode(text.id_tokens(F.col(topic))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("count"))


def top_topics(df: DataFrame, topic: str = "topic", count: int = 7) -> DataFrame:
    """Labels of the most frequent topics, by position; at most ``count`` rows.

    Ties are broken by name. Topics sharing a label keep the first position.
    """
    top = topic_counts(df, topic).orderBy(F.desc("count"), "token").limit(count)
    ordered = F.array_sort(
        F.collect_list(F.struct(-F.col("count"), "token", text.topic_label(F.col("token")).alias("label")))
    )
    labels = top.select(ordered.alias("top")).select(F.array_distinct(F.col("top.label")).alias("l"))
    return labels.select(F.posexplode("l").alias("position", "label"))


def with_category(df: DataFrame, topic: str, labels: DataFrame, name: str) -> DataFrame:
    """Add the first label that occurs in the topic. The labels are read by a one-row subquery."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "label")))
    array = labels.agg(ordered.alias("l")).select(F.col("l.label")).scalar()
    found = text.topic_category(F.col(topic), F.col("_labels"))
    return df.withColumn("_labels", array).withColumn(name, found).drop("_labels")


def cap_listing(listing: DataFrame, keys: list[str], order: list[str], limit: int = 20) -> DataFrame:
    """The first ``limit`` ids of each list, in page order."""
    return first_rows(listing, keys, [F.asc(c) for c in order], limit)
