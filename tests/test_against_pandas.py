"""The analyses on random data, worked out again with pandas and plain Python."""

import datetime as dt
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from viewtide.functions import durations
from viewtide.plans import channel_distribution as distribution, duration_trend, view_sub_ratio as view_sub

D = dt.date
VIDEO = "video_id string, channel_id string, video_type string, published_date date, duration string"
VIDEO_LOG = "video_id string, created_date date, view_count long"
CHANNEL_LOG = "channel_id string, created_date date, view_count long, sub_count long, video_count long"


@pytest.fixture(scope="module", params=[1, 2])
def world(request):
    pick = random.Random(request.param)
    days = [D(2024, 3, d) for d in range(1, 12)]
    video, log = [], []
    for n in range(600):
        # A third of the videos belong to one channel, and most are of a few lengths.
        channel = "c0" if n % 3 == 0 else f"c{pick.randrange(1, 15)}"
        seconds = pick.choice([299, 300, 301, 60 * pick.randrange(0, 62), pick.randrange(4000)])
        clock = f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"
        published = D(2024, 3, 1) - dt.timedelta(days=pick.randrange(60))
        video.append((f"v{n}", channel, pick.choice(["video", "video", "short"]), published, clock))
        for day in pick.sample(days, pick.randrange(0, 6)):
            log.append((f"v{n}", day, pick.randrange(1000)))
    names = ["Music", "Pop_Music", "Film", "Lifestyle_(sociology)", "Pets", "Food", "Sport", "Games", "News"]
    channel = [
        (f"c{n}", pick.choice([f"n{n}", f"n{n}", "twin"]), ", ".join(pick.sample(names, pick.randrange(1, 4))))
        for n in range(15)
    ]
    channel_log = [
        (c, day, pick.randrange(100), pick.randrange(50), n) for c, *_ in channel for n, day in enumerate(days)
    ]
    return video, log, channel, channel_log


def latest(frame, key):
    return frame.sort_values("created_date", kind="stable").drop_duplicates(key, keep="last")


def video_frames(world, age):
    video, log, *_ = world
    v = pd.DataFrame(video, columns=["video_id", "channel_id", "video_type", "published_date", "duration"])
    joined = latest(pd.DataFrame(log, columns=["video_id", "created_date", "view_count"]), "video_id").merge(
        v[v.video_type == "video"], on="video_id"
    )
    days = (pd.to_datetime(joined.created_date) - pd.to_datetime(joined.published_date)).dt.days
    return joined[days >= age]


def test_trend_by_bin(spark, world):
    frame = video_frames(world, 7)
    length = pd.to_timedelta(frame.duration).dt.ceil("min")
    frame = frame.assign(minutes=length.dt.total_seconds() / 60)
    frame = frame[length < dt.timedelta(hours=1)]
    sizes = frame.minutes.value_counts()
    frame = frame[frame.minutes.isin(sizes[sizes > 2].index)]
    cut = pd.cut(frame.minutes, bins=20, include_lowest=True, precision=0)
    labels = cut.map(lambda c: f"{int(c.left)}~{int(c.right)}")
    expected = {
        (code + 1, label): (len(part), part.median())
        for (code, label), part in frame.view_count.groupby([cut.cat.codes, labels.astype(str)])
    }
    found = duration_trend.by_bin(
        spark.createDataFrame(world[0], VIDEO), spark.createDataFrame(world[1], VIDEO_LOG), more_than=2
    )
    assert {(r.bin, r.label): (r["count"], r.median_view_count) for r in found.collect()} == expected


def test_trend_by_minute(spark, world):
    frame = video_frames(world, 7)
    parts = frame.duration.str.split(":", expand=True).astype(int)
    frame = frame.assign(minute=parts[1])[parts[0] == 0]
    groups = frame.groupby("minute").view_count.agg(["count", "mean"])
    expected = {m: (r["count"], pytest.approx(r["mean"])) for m, r in groups[groups["count"] > 2].iterrows()}
    found = duration_trend.by_minute(
        spark.createDataFrame(world[0], VIDEO), spark.createDataFrame(world[1], VIDEO_LOG), more_than=2
    )
    assert {r.duration_minute: (r["count"], r.avg_view_count) for r in found.collect()} == expected


def test_top_channels(spark, world):
    video, log, channel, channel_log = world
    subs = latest(pd.DataFrame(channel_log, columns=["channel_id", "created_date", "x", "sub_count", "y"]), "channel_id")
    frame = video_frames(world, 31).merge(pd.DataFrame(channel, columns=["channel_id", "name", "topic"]), on="channel_id")
    frame = frame.merge(subs[["channel_id", "sub_count"]], on="channel_id", how="left")
    frame = frame.assign(ratio=(frame.view_count / frame.sub_count).where(frame.sub_count > 0))
    means = frame.groupby("name").agg(ratio=("ratio", "mean"), subs=("sub_count", "mean")).reset_index()
    means = means.sort_values(["ratio", "name"], ascending=[False, True])[:10]

    views = view_sub.old_views(spark.createDataFrame(video, VIDEO), spark.createDataFrame(log, VIDEO_LOG))
    named = view_sub.subscribers(
        spark.createDataFrame(channel, "channel_id string, name string, topic string"),
        spark.createDataFrame(channel_log, CHANNEL_LOG),
    )
    top = view_sub.top_channels(views, named).collect()
    assert [r.name for r in top] == list(means.name)
    assert [r.avg_view_sub_ratio for r in top] == pytest.approx(list(means.ratio), nan_ok=True)
    assert [r.sub_count for r in top] == pytest.approx(list(means.subs))

    for row in view_sub.ratio_spread(views, named).collect():
        ratios = frame[frame.name == row.name].ratio.dropna()
        q1, q3 = ratios.quantile(0.25), ratios.quantile(0.75)
        inside = ratios[ratios.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
        figures = [ratios.min(), q1, ratios.median(), q3, ratios.max(), inside.min(), inside.max()]
        found = [row.lowest, row.q1, row.median, row.q3, row.highest, row.lower_whisker, row.upper_whisker]
        assert (row.rows, found) == (len(ratios), pytest.approx(figures))


def test_channel_distribution(spark, world):
    *_, channel, channel_log = world
    tokens = [t for _, _, topic in channel for t in topic.replace(" ", "").split(",")]
    top = sorted(Counter(tokens).items(), key=lambda item: (-item[1], item[0]))[:7]
    labels = ["Lifestyle" if t == "Lifestyle_(sociology)" else "Music" if "Music" in t else t for t, _ in top]
    expected = {c: next((label for label in labels if label in topic), "Other") for c, _, topic in channel}
    found = distribution.channel_distribution(
        spark.createDataFrame(channel, "channel_id string, name string, topic string"),
        spark.createDataFrame(channel_log, CHANNEL_LOG),
    )
    assert {r.channel_id: r.topic for r in found.collect()} == expected


def test_iso_durations(spark):
    pick = random.Random(5)
    lengths = [0, 59, 60, 3600, 86400] + [pick.randrange(10**6) for _ in range(300)]

    def stored(seconds):
        parts = [(seconds // 86400, "D"), (seconds // 3600 % 24, "H"), (seconds // 60 % 60, "M"), (seconds % 60, "S")]
        texts = [f"{n}{unit}" if n else "" for n, unit in parts]
        if seconds == 0:
            texts[3] = "0S"
        return "P" + texts[0] + ("T" if any(texts[1:]) else "") + "".join(texts[1:])

    df = spark.createDataFrame([(stored(n), n) for n in lengths], "t string, n long")
    df = df.withColumn("s", durations.iso_seconds(F.col("t")))
    df = df.withColumn("back", durations.clock_seconds(durations.clock_text(F.col("s"))))
    assert df.where("s is null or s <> n or back <> n").collect() == []
