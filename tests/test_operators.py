import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from viewtide.operators import (
    aggregates,
    columns,
    dedup,
    filters,
    joins,
    positions,
    quality,
    quantiles,
    topk,
    windows,
)

D = dt.date


def test_cleaning(spark, rows):
    df = spark.createDataFrame(
        [("1", float("nan"), None), ("x", 2.0, "a")], "n string, x double, t string"
    )
    assert rows(columns.cast_counters(df, ["n"]), "n") == [(None,), (1,)]
    assert rows(columns.nan_to_null(df), "x") == [(None,), (2.0,)]
    assert rows(columns.fill_text(df), "t") == [("NULL",), ("a",)]
    assert rows(columns.drop_incomplete(df), "n") == [("x",)]


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), D(2024, 1, 8)), ("b", D(2024, 1, 1), D(2024, 1, 7)), (None, None, D(2024, 1, 8))],
        "name string, published date, seen date",
    )
    assert rows(filters.aged(df, "seen", "published", 7), "name") == [("a",)]
    assert rows(filters.aged(df, "seen", "published", 7, strict=True), "name") == []
    assert rows(filters.not_listed(df, "name", ["a"]), "name") == [("b",)]
    assert rows(filters.on_days(df, "seen", [D(2024, 1, 7)]), "name") == [("b",)]
    assert rows(filters.of_latest_day(df, "seen"), "name") == [(None,), ("a",)]


def test_min_count(spark, rows):
    df = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2 + [(None,)] * 9, "k int")
    assert rows(filters.with_min_count(df, ["k"], 2)) == [(1,)] * 3
    assert rows(joins.with_group_count(df, ["k"])) == [(1, 3)] * 3 + [(2, 2)] * 2


def test_latest_does_not_depend_on_partitions(spark, rows):
    data = [(k, D(2024, 1, 1 + n % 5), n % 7, f"t{n % 3}") for k in range(20) for n in range(40)]
    expected = {k: max((d, c, t) for kk, d, c, t in data if kk == k) for k in range(20)}
    for seed, parts in ((1, 1), (2, 7), (3, 16)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, created_date date, c int, t string").repartition(parts)
        found = rows(dedup.latest_per_key(df, ["k"], ["created_date"]))
        assert found == [(k, *expected[k]) for k in range(20)]
        firsts = rows(dedup.first_per_key(df, ["k"], ["created_date"]), "k", "created_date", "c")
        assert firsts == sorted((k, *min((d, c) for kk, d, c, _ in data if kk == k)) for k in range(20))


def test_whole_rows_as_key(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert rows(dedup.latest_per_key(df, ["a", "b"], [])) == [(1, 2), (1, 3)]


def test_latest_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id as created_date")
    plan = dedup.latest_per_key(df, ["k"], ["created_date"])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange hashpartitioning")


def test_with_latest(spark, rows):
    log = spark.createDataFrame(
        [("c1", D(2024, 1, 2), 20), ("c1", D(2024, 1, 1), 99), ("c3", D(2024, 1, 1), 5)],
        "channel_id string, created_date date, sub_count int",
    )
    video = spark.createDataFrame([("v1", "c1"), ("v2", "c2")], "video_id string, channel_id string")
    joined = joins.with_latest(video, log, "channel_id", ["sub_count"])
    assert rows(joined, "video_id", "sub_count") == [("v1", 20)]
    kept = joins.with_latest(video, log, "channel_id", ["sub_count"], "left")
    assert rows(kept, "video_id", "sub_count") == [("v1", 20), ("v2", None)]


def test_latest_of_a_day_goes_by_time_of_writing(spark, rows):
    at = dt.datetime(2024, 1, 1, 9)
    data = [("k", D(2024, 1, 1), 9, at), ("k", D(2024, 1, 1), 5, at + dt.timedelta(hours=1))]
    log = spark.createDataFrame(data, "k string, created_date date, view_count int, created_at timestamp")
    assert rows(dedup.latest_snapshot(log, "k", ["view_count"])) == [("k", 5, D(2024, 1, 1))]
    untimed = log.drop("created_at")
    assert rows(dedup.latest_snapshot(untimed, "k", ["view_count"])) == [("k", 9, D(2024, 1, 1))]


def test_not_stored_keeps_repeats(spark, rows):
    found = spark.createDataFrame([("video", "id1"), ("video", "id1"), ("short", "id2")], "t string, id string")
    none = found.where("false")
    assert len(rows(joins.not_stored(found, none, ["t", "id"]))) == 3
    assert rows(joins.not_stored(found, found, ["t", "id"])) == []
    stored = spark.createDataFrame([("video", "id2")], "t string, id string")
    assert len(rows(joins.not_stored(found, stored, ["t", "id"]))) == 3


@pytest.fixture
def many_pieces(spark):
    """Small pieces, so that groups are spread over several of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def skewed(seed=0, count=3000):
    """A third of the rows in one group and many equal values, with nulls in both columns."""
    pick = random.Random(seed)
    for n in range(count):
        group = "hot" if n % 3 == 0 else pick.choice(["a", "b", "c", None])
        value = 7 if n % 4 == 0 else pick.choice([None, *range(50)])
        yield n, group, value


def by_group(data):
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    return groups


def low(value):
    return (value is not None, value or 0)


def test_number_rows(spark, many_pieces):
    data = list(skewed())
    df = spark.createDataFrame(data, "id int, g string, v int").repartition(5)
    found = positions.number_rows(df, ["g"], [F.asc("v"), F.asc("id")], "place")
    assert found.columns == ["id", "g", "v", "place"]
    expected = {}
    for members in by_group(data).values():
        members.sort(key=lambda row: (low(row[2]), row[0]))
        expected |= {row[0]: place for place, row in enumerate(members, 1)}
    assert {r.id: r.place for r in found.collect()} == expected


def test_groups_are_spread(spark, many_pieces):
    df = spark.createDataFrame(list(skewed()), "id int, g string, v int")
    pieces = positions.cut(df, ["g"], [F.asc("v"), F.asc("id")])
    hot = pieces.where("g = 'hot'").select(positions.PIECE).distinct().count()
    assert hot > 1


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_rows(spark, many_pieces, keys, descending):
    data = list(skewed(1))
    df = spark.createDataFrame(data, "id int, g string, v int")
    found = positions.rank_rows(df, keys, "v", "rank", descending)
    expected = {}
    for members in by_group(data).values() if keys else [data]:
        for row in members:
            me = low(row[2])
            ahead = (low(o[2]) > me if descending else low(o[2]) < me for o in members)
            expected[row[0]] = 1 + sum(ahead)
    assert {r.id: r.rank for r in found.collect()} == expected


def test_running_total(spark, many_pieces):
    data = [(n, n % 2, n % 5) for n in range(500)]
    df = spark.createDataFrame(data, "id int, g int, w int")
    found = positions.running_total(df, ["g"], [F.asc("id")], F.col("w"), "before")
    total, expected = {0: 0, 1: 0}, {}
    for n, g, w in data:
        expected[n] = total[g]
        total[g] += w
    assert {r.id: r.before for r in found.collect()} == expected


POINTS = {"least": 0.0, "q1": 0.25, "q2": 0.5, "most": 1.0}


def check_quantiles(found, data):
    frame = pd.DataFrame(data, columns=["id", "g", "v"]).dropna(subset="v")
    found = {row.g: row for row in found.collect()}
    assert set(found) == {g if isinstance(g, str) else None for g in frame.g}
    for g, row in found.items():
        values = frame[frame.g == g].v if g else frame[frame.g.isna()].v
        assert row.rows == len(values)
        assert [row[p] for p in POINTS] == pytest.approx([values.quantile(q) for q in POINTS.values()])


def test_quantiles(spark, many_pieces):
    data = list(skewed(2))
    df = spark.createDataFrame(data, "id int, g string, v int")
    placed = quantiles.place_values(df, ["g"], "v")
    check_quantiles(quantiles.quantiles(placed, ["g"], "v", POINTS), data)


@pytest.mark.parametrize("slack, accuracy", [(0.01, 200), (0.0, 2), (0.3, 3), (0.001, 10)])
@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_exact_quantiles(spark, many_pieces, monkeypatch, slack, accuracy, limit):
    """Also where brackets miss, and with brackets broadcast or not, as Spark decides by its limit."""
    monkeypatch.setattr(quantiles, "SLACK", slack)
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    pick = random.Random(accuracy)
    data = list(skewed(3))
    data += [(n, pick.choice(["hot", "wide", None]), pick.randrange(10**6)) for n in range(3000)]
    data += [(0, "one", 5), (1, "two", 5), (2, "two", 8), (3, "none", None)]
    df = spark.createDataFrame(data, "id int, g string, v int")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, limit)
    try:
        check_quantiles(quantiles.exact_quantiles(df, ["g"], "v", POINTS), data)
    finally:
        spark.conf.unset(setting)


def test_far_values_are_counted_not_shuffled(spark):
    df = spark.range(100000).selectExpr("id % 2 as g", "id * 7919 % 100003 as v")
    coarse = quantiles._coarsened(df, ["g"], "v", {"median": 0.5})
    assert coarse.distinct().count() < 200


def test_medians_with_weights_and_sketch(spark, rows):
    df = spark.createDataFrame([("a", 1, 3), ("a", 5, 1), ("b", 7, 2), ("b", 9, 2)], "g string, v int, w int")
    placed = quantiles.place_values(df, ["g"], "v", F.col("w"))
    found = quantiles.quantiles(placed, ["g"], "v", {"median": 0.5})
    assert rows(found) == [("a", 4, 1.0), ("b", 4, 8.0)]
    assert rows(quantiles.medians(df, ["g"], "v")) == [("a", 2, 3.0), ("b", 2, 8.0)]
    assert rows(quantiles.approximate_medians(df, ["g"], "v")) == [("a", 2, 1), ("b", 2, 7)]


@pytest.mark.parametrize(
    "values",
    [
        [1, 2, 3, 10, 30, 59],
        list(range(1, 60)),
        [2, 3, 3, 4, 7],
        [5, 5],
        [1, 21],
        [0, 40, 20, 13],
    ],
)
def test_bins_agree_with_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = aggregates.equal_width_bins(df, "v", 20).select("v", "bin", "label").collect()
    cut = pd.cut(pd.Series(values, dtype=float), bins=20, include_lowest=True, precision=0)
    names = [f"{int(c.left)}~{int(c.right)}" for c in cut.dtype.categories]
    expected = {v: (code + 1, names[code]) for v, code in zip(values, cut.cat.codes)}
    assert {r.v: (r.bin, r.label) for r in found} == expected


def test_pivot_names(spark, rows):
    df = spark.createDataFrame([("k", 1, 10), ("k", 3, 30)], "k string, n int, v int")
    wide = aggregates.pivot_by_ordinal(df, "k", "n", 3, {"v": "view"})
    assert wide.columns == ["k", "1_view", "2_view", "3_view"]
    assert rows(wide) == [("k", 10, None, 30)]


def test_side_by_side_equals_pivot(spark, rows):
    data = [(k, n, k * n, -n) for k in range(5) for n in range(1, 3 + k)]
    df = spark.createDataFrame(data, "k int, n int, v int, w int").repartition(7)
    names = {"v": "view", "w": "like"}
    wide = aggregates.side_by_side(df, "k", "n", 4, names)
    pivot = aggregates.pivot_by_ordinal(df, "k", "n", 4, names)
    assert wide.columns == pivot.columns
    assert rows(wide) == rows(pivot)


def test_checkpoint_deltas(spark, rows):
    days = [1, 7, 13, 19, 25]
    data = [("full", D(2024, 1, d), 10 * d) for d in days]
    data += [("gap", D(2024, 1, d), d) for d in (1, 13, 19, 25)]
    log = spark.createDataFrame(data, "channel_id string, created_date date, sub_count int")
    found = windows.checkpoint_deltas(log, "channel_id", ["sub_count"])
    assert rows(found) == [
        ("full", 1, 60), ("full", 2, 60), ("full", 3, 60), ("full", 4, 60),
        ("gap", 1, 12), ("gap", 2, 6), ("gap", 3, 6), ("gap", 4, None),
    ]


def test_period_delta_goes_by_date(spark, rows):
    data = [("c", D(2024, 1, d), 100 - d) for d in range(1, 29)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        log = spark.createDataFrame(data, "channel_id string, created_date date, sub_count int")
        found = aggregates.period_delta(log.repartition(4), "channel_id", ["sub_count"], "monthly")
        assert rows(found) == [("c", -27)]
        assert found.columns == ["channel_id", "monthly_sub_delta"]


def test_snapshots_are_numbered_by_day(spark, rows):
    data = [("v", D(2024, 1, d), d) for d in (9, 2, 5, 30)]
    log = spark.createDataFrame(data, "video_id string, created_date date, view_count int")
    numbered = windows.snapshot_ordinal(log, "video_id")
    assert rows(numbered, "ordinal", "view_count") == [(1, 2), (2, 5), (3, 9), (4, 30)]
    assert rows(windows.first_snapshots(log, "video_id", 2), "view_count") == [(2,), (5,)]


def test_top_topics(spark, rows):
    topics = ["Lifestyle_(sociology), Pop_Music", "Music, Zebra", "Music, Apple", None]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    assert rows(topk.topic_counts(df))[0] == ("Apple", 1)
    # Ties go by name; two kinds of music share the first place.
    assert rows(topk.top_topics(df, count=4)) == [(0, "Music"), (1, "Apple"), (2, "Lifestyle")]
    labels = topk.top_topics(df, count=4)
    found = topk.with_category(df, "topic", labels, "category")
    assert rows(found, "category") == [("Music",), ("Music",), ("Music",), ("Other",)]


def test_listing_cap(spark, rows):
    listed = spark.createDataFrame([("c", n, f"id{n}") for n in (3, 1, 2)], "c string, pos int, id string")
    assert rows(topk.cap_listing(listed, ["c"], ["pos"], 2), "id") == [("id1",), ("id2",)]


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (2, None)], "k int, v string")
    assert rows(quality.primary_key(df, ["k"])) == [(None, 1), (1, 2)]
    assert rows(quality.unique(df, "v")) == [("b", 2)]
    assert rows(quality.not_null(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(quality.length(df, {"v": 2}, {})) == [("v", 3)]
    assert rows(quality.length(df, {}, {"v": 1})) == []
    assert rows(quality.in_set(df, "k", [0, 1])) == [(2, 1)]
    assert rows(quality.foreign_key(df, "v", spark.createDataFrame([("a",)], "p string"), "p")) == [("b", 2)]


def test_report(spark, rows):
    tables = {
        "status_code": spark.createDataFrame([(0, "new"), (0, "new"), (3, None)], "status_id smallint, name string"),
    }
    assert rows(quality.report(tables)) == [
        ("status_code", "check", "status_id", 1),
        ("status_code", "not null", "name", 1),
        ("status_code", "primary key", "status_id", 2),
        ("status_code", "unique", "name", 2),
    ]


def test_hot_join_key_is_split(spark):
    """A key with most of the rows is read by several tasks where sizes call for it."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(200000, numPartitions=8).selectExpr("if(id % 3 > 0, 0, id) as k", "id")
        right = spark.range(1000).selectExpr("id as k", "id as r")
        joined = joins.join_null_safe(left, right, ["k"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in changed:
            spark.conf.unset(name)
