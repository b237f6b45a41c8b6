"""What the physical plans must look like for the jobs to hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from viewtide.operators import dedup, filters, quality
from viewtide.operators.joins import star
from viewtide.plans import duration_trend, ingest, monthly_channel_fact as monthly, video_fact as videos
from viewtide.plans.view_sub_ratio import old_views, subscribers, top_channels
from viewtide.sources.writers import write_table

D = dt.date


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Stored tables in which one channel has a third of the videos."""
    folder = tmp_path_factory.mktemp("tables")
    n = F.col("id")
    channel_id = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), n % 50))
    video = spark.range(300).select(
        F.concat(F.lit("v"), n).alias("video_id"),
        channel_id.alias("channel_id"),
        F.lit("t").alias("title"),
        F.lit("video").alias("video_type"),
        F.lit(D(2023, 12, 1)).alias("published_date"),
        F.lit(dt.datetime(2023, 12, 1, 8)).alias("published_time"),
        F.lit("00:05:30").alias("duration"),
        F.lit("long text that no job needs").alias("description"),
        F.lit(True).alias("active"),
    )
    days = F.explode(F.sequence(F.lit(D(2024, 1, 1)), F.lit(D(2024, 2, 9)))).alias("created_date")
    log = spark.range(300).select(F.concat(F.lit("v"), n).alias("video_id"), n, days)
    counters = [F.col("id").alias(c) for c in ("view_count", "like_count", "comment_count")]
    channel = spark.range(51).select(
        F.when(n == 50, "hot").otherwise(F.concat(F.lit("c"), n)).alias("channel_id"),
        F.concat(F.lit("name "), n).alias("name"),
        F.lit("a, b").alias("topic"),
    )
    channel_log = channel.select("channel_id", days).select(
        "channel_id", "created_date", *[F.lit(5).cast("long").alias(c) for c in monthly.COUNTERS]
    )
    frames = {
        "video": (video, None),
        "video_log": (log.select("video_id", "created_date", *counters), "created_date"),
        "channel": (channel, None),
        "channel_log": (channel_log, "created_date"),
    }
    stored = {}
    for name, (df, partition) in frames.items():
        write_table(df, f"{folder}/{name}", partition)
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    return stored


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """As with tables above the size limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_and_one_pruned_scan_for_monthly_growth(tables):
    growth = monthly.monthly_growth(tables["channel_log"], D(2024, 2, 10))
    plan = physical(growth)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "Window" not in plan and "SortAggregate" not in plan
    assert re.search(r"PartitionFilters: \[.*created_date.* >= 2024-01-01", plan)


def test_ranks_are_not_worked_out_in_one_task(tables):
    fact = monthly.monthly_channel_fact(tables["channel_log"], D(2024, 2, 10))
    plan = physical(fact)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    for window in re.findall(r"Window \[sum\(_amount[^\n]*", plan):
        assert "_piece" in window


def test_snapshots_are_cut_before_the_shuffle(tables):
    plan = physical(videos.snapshots_wide(tables["video_log"], 30))
    assert plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_log_is_shuffled_once_for_the_star(tables):
    joined = star(*(tables[t] for t in ("video", "video_log", "channel", "channel_log")))
    plan = physical(joined)
    # Between the last join and its first scan, the log's, there is one exchange.
    log_side = plan[plan.index("SortMergeJoin") : plan.index("FileScan")]
    assert log_side.count("SortMergeJoin") == 1 and log_side.count("Exchange") == 1


def test_views_are_summed_before_they_meet_the_channel(tables):
    views = old_views(tables["video"], tables["video_log"])
    top = top_channels(views, subscribers(tables["channel"], tables["channel_log"]))
    plan = physical(top)
    assert plan.startswith("AdaptiveSparkPlan") and "TakeOrderedAndProject" in plan
    join = plan.index("SortMergeJoin")
    assert "partial_sum(view_count" in plan[join:]


def test_scans_read_only_what_is_needed(tables):
    trend = duration_trend.by_minute(tables["video"], tables["video_log"])
    plan = physical(trend)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "description" not in schema and "like_count" not in schema
    assert "EqualTo(video_type,video)" in plan


def test_latest_day_prunes_partitions(tables):
    plan = physical(filters.of_latest_day(tables["channel_log"]))
    assert re.search(r"PartitionFilters: \[[^\]]*created_date[^\]]*Subquery", plan)


def test_foreign_keys_are_counted_before_the_join(tables):
    orphans = quality.foreign_key(tables["video_log"], "video_id", tables["video"], "video_id")
    plan = physical(orphans)
    assert plan.index("LeftAnti") < plan.index("partial_count")


def test_expiry_needs_no_shuffle(tables):
    plan = physical(ingest.expire_videos(tables["video"], D(2024, 2, 10)))
    assert "Exchange" not in plan and "Python" not in plan


def test_first_row_per_key_sorts_in_the_input_tasks(tables):
    plan = physical(dedup.latest_per_key(tables["video"], ["channel_id"], ["published_date"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
