"""Partitioned updates, old versions, buckets, partials of a month, sketches and rejected documents."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from viewtide.operators.aggregates import period_delta
from viewtide.operators.joins import star
from viewtide.operators.quantiles import sketched_quantiles, value_sketches
from viewtide.plans import daily, monthly_channel_fact as monthly
from viewtide.plans.video_fact import snapshots_wide
from viewtide.session import delete_folder, scratch_scope, settled
from viewtide.sources import writers

D = dt.date


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def videos(spark, tmp_path):
    """Videos of sixty days, a third of them on one day."""
    n = F.col("id")
    day = F.when(n % 3 == 0, F.lit(D(2024, 1, 1))).otherwise(F.date_add(F.lit(D(2024, 1, 1)), (n % 60).cast("int")))
    rows = spark.range(600).select(F.concat(F.lit("v"), n).alias("video_id"), (n % 2 == 0).alias("active"), n.alias("n"), day.alias("published_date"))
    path = f"{tmp_path}/video"
    writers.write_table(rows, path, "published_date")
    return path


def test_update_leaves_other_partitions(spark, rows, videos):
    before, stored = files(videos), rows(spark.read.parquet(videos), "video_id", "active", "n", "published_date")
    changed = daily.expire_partitioned(spark, videos, D(2024, 2, 5), days=30)
    expected = [(v, a and d >= D(2024, 1, 6), n, d) for v, a, n, d in stored]
    assert rows(spark.read.parquet(videos), "video_id", "active", "n", "published_date") == expected
    assert changed == sum(a != b for (_, a, _, _), (_, b, _, _) in zip(stored, expected)) > 0
    after = files(videos)
    kept = {f for f in before if f in after and before[f] == after[f]}
    touched = {re.search("published_date=([^/]+)", f)[1] for f in set(before) - kept}
    assert touched and touched <= {f"2024-01-0{d}" for d in range(1, 6)}
    assert daily.expire_partitioned(spark, videos, D(2024, 2, 5), days=30) == 0 and files(videos) == after


def test_update_reads_touched_partitions_only(spark, videos):
    chosen = spark.read.parquet(videos).where(F.col("published_date").isin([D(2024, 1, 2)]))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*published_date", plan)


def test_update_refuses_the_partition_column(spark, videos):
    with pytest.raises(ValueError):
        writers.update_partitions(spark, videos, "published_date", F.lit(True), {"published_date": F.lit(None)})


def test_failed_update_of_partitions(spark, rows, videos):
    stored = rows(spark.read.parquet(videos), "video_id", "active")
    with pytest.raises(Exception, match="lost"):
        writers.update_partitions(spark, videos, "published_date", F.col("active"), {"active": F.raise_error(F.lit("lost")).cast("boolean")})
    assert rows(spark.read.parquet(videos), "video_id", "active") == stored


def test_null_partition_is_updated(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, n int, p string")
    writers.write_table(df, f"{tmp_path}/t", "p")
    assert writers.update_partitions(spark, f"{tmp_path}/t", "p", F.col("n") == 1, {"n": F.lit(9)}) == 1
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "k", "n", "p") == [("a", 9, None), ("b", 2, "x")]


def test_old_versions_go(spark, rows, tmp_path):
    spark.createDataFrame([("a", 1)], "k string, n int").write.parquet(f"{tmp_path}/first")
    spark.catalog.createTable("versioned", f"{tmp_path}/first", "parquet")
    try:
        for _ in range(3):
            writers.update_table(spark, "versioned", str(tmp_path), lambda t, c: writers.updated(t, F.lit(True), {"n": F.col("n") + 1}, c))
        assert writers.drop_versions(spark, "versioned", str(tmp_path)) == 2
        assert writers.drop_versions(spark, "versioned", str(tmp_path)) == 0
        assert rows(spark.table("versioned")) == [("a", 4)]
    finally:
        spark.sql("DROP TABLE versioned")


def test_scratch_goes_at_the_end(spark, tmp_path):
    with scratch_scope(spark):
        df = settled(spark.range(3))
        path = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert df.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)
    delete_folder(spark, f"{tmp_path}/not there")


def test_buckets_are_not_shuffled(spark, rows, tmp_path):
    """Neither the star join nor the snapshots side by side move the log."""
    n = F.col("id")
    day = F.date_add(F.lit(D(2024, 1, 1)), (n % 10).cast("int")).alias("created_date")
    log = spark.range(400).select(F.concat(F.lit("v"), n % 40).alias("video_id"), n.alias("view_count"), n.alias("like_count"), n.alias("comment_count"), day)
    video = spark.range(40).select(F.concat(F.lit("v"), n).alias("video_id"), F.lit("c").alias("channel_id"), F.lit("video").alias("video_type"), F.lit(D(2024, 1, 1)).alias("published_date"))
    channel = spark.createDataFrame([("c", "name")], "channel_id string, name string")
    channel_log = spark.createDataFrame([("c", 5, D(2024, 1, 1))], "channel_id string, sub_count long, created_date date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = writers.write_bucketed(log, "bucketed_log", f"{tmp_path}/log", "video_id", 4)
        joined, wide = star(video, stored, channel, channel_log), snapshots_wide(stored, 3)
        assert rows(joined, "video_id", "view_count") == rows(star(video, log, channel, channel_log), "video_id", "view_count")
        assert rows(wide) == rows(snapshots_wide(log, 3))
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("== Initial")[0]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "bucketed_log" in line)
        depth = lines[scan].index("FileScan")
        above = []
        for line in reversed(lines[:scan]):  # the operators between the scan and the join
            at = re.search(r"[A-Za-z]", line).start()
            if at < depth:
                above.append(line)
                depth = at
            if "SortMergeJoin" in line:
                break
        assert not any("Exchange" in line for line in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_log")


@pytest.fixture
def log(spark):
    """Two months with gaps, days written twice, and channels that are seen once."""
    draw = random.Random(1)
    out = []
    for channel in range(30):
        for d in range(60):
            for again in range(draw.choice([0, 1, 1, 1, 2])):
                levels = [draw.randrange(1000) for _ in range(3)]
                out.append((f"c{channel}", *levels, D(2024, 1, 1) + dt.timedelta(days=d), dt.datetime(2024, 4, 1, draw.randrange(24), draw.randrange(60), again)))
    out.append(("once", 1, 2, 3, D(2024, 1, 7), dt.datetime(2024, 4, 1)))
    return spark.createDataFrame(out, "channel_id string, sub_count long, view_count long, video_count long, created_date date, created_at timestamp")


@pytest.mark.parametrize("aligned", [False, True])
@pytest.mark.parametrize("timed", [False, True])
def test_partials_give_the_month(spark, rows, log, aligned, timed):
    """Day by day, in any order and with days run again, equals all at once."""
    if not timed:
        log = log.groupBy("channel_id", "created_date").agg(*[F.max(c).alias(c) for c in monthly.COUNTERS])
    parts = [log.where((F.dayofyear("created_date") % 7) == i) for i in (3, 0, 6, 1, 5, 2, 4)]
    held = settled(monthly.month_partials(parts[0]))
    for part in [*parts[1:], parts[2], parts[0]]:
        held = settled(monthly.merged_partials(held, monthly.month_partials(part)))
    for as_of in (D(2024, 2, 15), D(2024, 3, 1)):
        assert rows(monthly.growth_of(held, as_of, aligned)) == rows(monthly.monthly_growth(log, as_of, aligned=aligned))
    nothing = monthly.month_partials(log.limit(0))
    assert rows(monthly.merged_partials(held, nothing)) == rows(held) and monthly.growth_of(nothing, D(2024, 2, 15)).collect() == []


def test_delta_of_days_written_twice(spark, rows):
    data = [("a", 5, D(2024, 1, 1), 1), ("a", 10, D(2024, 1, 3), 1), ("a", 25, D(2024, 1, 3), 2)]
    for order in (data, data[::-1]):
        log = spark.createDataFrame(order, "channel_id string, sub_count long, created_date date, at int").coalesce(1)
        log = log.withColumn("created_at", F.timestamp_seconds("at")).drop("at")
        assert rows(period_delta(log, "channel_id", ["sub_count"], "monthly")) == [("a", 20)]


def test_stored_sketches(spark):
    """Sketches of days, merged, stay within the bound that their size gives, and are exact for few values."""
    n = F.col("id")
    df = spark.range(60000).select((n % 3).alias("g"), (n % 11).alias("day"), F.pmod(F.xxhash64("id"), F.lit(100003)).alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 0, 7), (9, 1, 5), (9, 1, None), (8, 0, None)], "g long, day long, v long"))
    stored = settled(value_sketches(df, ["g", "day"], "v"))
    found = {r.g: r for r in sketched_quantiles(stored, ["g"], {"low": 0.25, "median": 0.5}).collect()}
    assert set(found) == {0, 1, 2, 9}
    for g in (0, 1, 2):
        values = sorted(r.v for r in df.where(F.col("g") == g).select("v").collect())
        assert found[g].rows == len(values) == 20000
        for share, value in ((0.25, found[g].low), (0.5, found[g].median)):
            assert abs(sum(v <= value for v in values) / len(values) - share) < 0.03
    assert (found[9].rows, found[9].median) == (2, 5.0)


def test_rejected_documents_are_stored(spark, rows, tmp_path):
    body = '{"items": [{"id": "c1", "statistics": {"viewCount": "5"}}]}'
    documents = spark.createDataFrame([("c1", body), ("c2", body[:20]), ("c3", None), ("c4", "{}")], "channel_id string, body string")
    path = f"{tmp_path}/rejected"
    for _ in range(2):
        daily.append_channel_counters(documents, D(2024, 2, 1), f"{tmp_path}/log", path)
    assert daily.keep_rejected(documents.where("channel_id = 'c2'"), D(2024, 2, 2), path) == 1
    stored = spark.read.parquet(path)
    assert rows(stored, "channel_id", F.col("rejected_on").cast("string")) == [("c2", "2024-02-01"), ("c2", "2024-02-02"), ("c3", "2024-02-01")]
    assert spark.read.parquet(f"{tmp_path}/log").count() == 1
