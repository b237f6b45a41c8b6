"""Scalar functions, column cleaning, filters, joins, aggregates, windows and checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from viewtide.functions import dates, durations, payload, ratios, text
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
from viewtide.plans.dimensions import channel_dimension as channel_dimension_plan
from viewtide.plans.dimensions import time_dimension_of
from viewtide.session import scratch_path
from viewtide.sources import writers
from viewtide.sources.readers import run_sql
from workload import views
from workload.registry import query, with_views
from workload.views import table

JANUARY = dt.date(2024, 1, 1)
CHECKPOINTS = "('2024-01-01', '2024-01-07', '2024-01-13', '2024-01-19', '2024-01-25')"

# --- dates and durations -------------------------------------------------


@query(
    """SELECT strftime(d, '%Y-%m-%d') AS date, year(d) AS year, month(d) AS month,
         day(d) AS day, weekofyear(d) AS week_of_year, dayofweek(d) + 1 AS day_of_week,
         quarter(d) AS quarter, dayofyear(d) AS day_of_year,
         dayofweek(d) IN (0, 6) AS is_weekend
       FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
               INTERVAL 1 DAY)) AS d FROM orders)"""
)
def time_dimension(spark, folder):
    return time_dimension_of(table(spark, folder, "orders"), "o_orderdate")


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events"""
)
def epoch_to_date(spark, folder):
    events = table(spark, folder, "events")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return events.select("event_id", dates.epoch_to_date(seconds).alias("day"))


@query("SELECT event_id, hour(ts) AS hour FROM events")
def published_hour(spark, folder):
    return table(spark, folder, "events").select("event_id", F.hour("ts").alias("hour"))


@query(
    """SELECT o_orderkey,
         strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m-%d') AS first_day,
         strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m-%d') AS last_day
       FROM orders"""
)
def month_bounds(spark, folder):
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.previous_month_start(day).alias("first_day"),
        dates.previous_month_end(day).alias("last_day"),
    )


@query(
    """SELECT o_orderkey, strftime(unnest([m, m + INTERVAL 6 DAY, m + INTERVAL 12 DAY,
         m + INTERVAL 18 DAY, m + INTERVAL 24 DAY]), '%Y-%m-%d') AS checkpoint
       FROM (SELECT o_orderkey, date_trunc('month', o_orderdate) AS m FROM orders)"""
)
def checkpoint_calendar(spark, folder):
    first = F.trunc(F.to_date("o_orderdate"), "month")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.explode(dates.month_checkpoints(first)).alias("checkpoint")
    )


@query(
    """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_date,
         strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS local_time FROM events"""
)
def tz_localize(spark, folder):
    stored = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    local = dates.local_timestamp(stored, "Asia/Taipei")
    return table(spark, folder, "events").select(
        "event_id",
        F.to_date(local).alias("local_date"),
        dates.clock_time(local).alias("local_time"),
    )


@query(
    """SELECT o_orderkey,
         CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed_date,
         CASE WHEN o_orderkey % 10 <> 0
           THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed_time
       FROM orders"""
)
def parse_dates(spark, folder):
    stored = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate").cast("string"))
    stored = F.coalesce(stored, F.lit("not a date"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.parse_date(stored).alias("parsed_date"),
        dates.parse_timestamp(stored).alias("parsed_time"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE (event_id * 37) % 200000 END AS seconds FROM events""",
    nullable=("seconds",),
)
def iso_duration(spark, folder):
    s = (F.col("event_id") * 37) % 200000

    def part(amount, unit):
        return F.when(amount > 0, F.concat(amount, F.lit(unit))).otherwise("")

    stored = F.concat(
        F.lit("P"), part(F.floor(s / 86400), "D"), F.lit("T"), part(F.floor(s / 3600) % 24, "H"),
        part(F.floor(s / 60) % 60, "M"), F.concat(s % 60, F.lit("S")),
    )
    stored = F.when(F.col("event_id") % 11 == 0, F.lit("about an hour")).otherwise(stored)
    return table(spark, folder, "events").select(
        "event_id", durations.iso_seconds(stored).alias("seconds")
    )


@query(
    """SELECT o_orderkey,
         CASE WHEN k = 0 THEN m WHEN k = 1 THEN h + 24 ELSE h END AS duration_hour,
         CASE WHEN k = 0 THEN s ELSE m END AS duration_minute,
         CASE WHEN k = 0 THEN NULL ELSE s END AS duration_second
       FROM (SELECT o_orderkey, o_orderkey % 10 AS k, ((o_orderkey * 97) % 5400 + 30) // 3600 AS h,
               (((o_orderkey * 97) % 5400 + 30) // 60) % 60 AS m,
               ((o_orderkey * 97) % 5400 + 30) % 60 AS s FROM orders)""",
    nullable=("duration_second",),
)
def duration_parts(spark, folder):
    n = F.col("o_orderkey")
    s = views.seconds_of(n)
    short = F.format_string("%02d:%02d", F.floor(s / 60) % 60, s % 60)
    clock = durations.clock_text(s)
    stored = (
        F.when(n % 10 == 0, short).when(n % 10 == 1, F.concat(F.lit("1 day "), clock)).otherwise(clock)
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", *[part.alias(name) for name, part in durations.clock_parts(stored).items()]
    )


@query(with_views(["video"], "SELECT video_id, round(seconds / 60.0, 6) AS minutes FROM video"))
def duration_minutes(spark, folder):
    minutes = durations.clock_minutes(F.col("duration"))
    return views.video(spark, folder).select("video_id", F.round(minutes, 6).alias("minutes"))


@query(with_views(["video"], "SELECT video_id, ceil(seconds / 60.0)::INTEGER AS minutes FROM video"))
def duration_ceil(spark, folder):
    minutes = durations.whole_minutes_up(durations.clock_seconds(F.col("duration")))
    return views.video(spark, folder).select("video_id", minutes.alias("minutes"))


@query(with_views(["video"], "SELECT video_id, duration FROM video WHERE seconds < 3600"))
def duration_filter(spark, folder):
    return filters.under_an_hour(views.video(spark, folder), "duration").select("video_id", "duration")


# --- casts, nulls and quotients ------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_custkey % 9 <> 0 THEN o_custkey END AS view_count,
         o_orderkey * 1000 AS sub_count FROM orders""",
    nullable=("view_count",),
)
def stat_cast(spark, folder):
    counters = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey").cast("string"))
        .otherwise("hidden")
        .alias("view_count"),
        (F.col("o_orderkey") * 1000).cast("string").alias("sub_count"),
    )
    return columns.cast_counters(counters, ["view_count", "sub_count"])


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer"""
)
def nan_to_null(spark, folder):
    balance = F.when(F.col("c_acctbal") < 0, float("nan")).otherwise(F.col("c_acctbal"))
    return columns.nan_to_null(
        table(spark, folder, "customer").select("c_custkey", balance.alias("c_acctbal"))
    )


@query(with_views(["channel"], "SELECT channel_id, coalesce(topic, 'NULL') AS topic FROM channel"))
def fill_null_topic(spark, folder):
    return columns.fill_text(views.channel(spark, folder).select("channel_id", "topic"))


@query(
    with_views(
        ["channel"],
        """SELECT channel_id, country, topic FROM channel
           WHERE country IS NOT NULL AND topic IS NOT NULL""",
    )
)
def drop_any_null(spark, folder):
    return columns.drop_incomplete(views.channel(spark, folder).select("channel_id", "country", "topic"))


@query(
    """SELECT o_orderkey, trunc(o_totalprice / nullif(o_custkey % 7, 0))::BIGINT AS quotient
       FROM orders""",
    nullable=("quotient",),
)
def int_ratio(spark, folder):
    quotient = ratios.int_ratio(F.col("o_totalprice"), F.col("o_custkey") % 7)
    return table(spark, folder, "orders").select("o_orderkey", quotient.alias("quotient"))


# --- filters -------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus = 'F'"""
)
def filter_eq(spark, folder):
    chosen = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return (
        table(spark, folder, "lineitem")
        .where(chosen)
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    )


@query(
    """SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN ('Brand#2', 'Brand#5', 'Brand#17')"""
)
def exclude_list(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    return filters.not_listed(part, "p_brand", ["Brand#2", "Brand#5", "Brand#17"])


@query(
    with_views(
        ["channel_log"],
        f"""SELECT channel_id, sub_count, strftime(created_date, '%Y-%m-%d') AS created_date
            FROM channel_log WHERE created_date IN {CHECKPOINTS}""",
    )
)
def checkpoint_filter(spark, folder):
    log = views.channel_log(spark, folder).select("channel_id", "sub_count", "created_date")
    return filters.on_days(log, "created_date", dates.checkpoint_days(JANUARY))


@query(
    with_views(
        ["video_log", "video"],
        """SELECT video_id, view_count, strftime(created_date, '%Y-%m-%d') AS created_date
           FROM video_log JOIN video USING (video_id) WHERE created_date - published_date >= 7""",
    )
)
def min_age_filter(spark, folder):
    published = views.video(spark, folder).select("video_id", "published_date")
    log = views.video_log(spark, folder).join(published, "video_id")
    kept = filters.aged(log, "created_date", "published_date", 7)
    return kept.select("video_id", "view_count", "created_date")


@query(
    """SELECT l_partkey, l_orderkey, l_quantity FROM lineitem
       WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 35)"""
)
def having_min_count(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", "l_quantity")
    return filters.with_min_count(lines, ["l_partkey"], 35)


@query(
    with_views(
        ["channel_log"],
        """SELECT channel_id, view_count, sub_count, video_count FROM channel_log
           WHERE created_date = (SELECT max(created_date) FROM channel_log)""",
    )
)
def latest_snapshot_global(spark, folder):
    latest = filters.of_latest_day(views.channel_log(spark, folder))
    return latest.select("channel_id", "view_count", "sub_count", "video_count")


@query(
    """SELECT l_partkey, l_orderkey, l_quantity FROM lineitem
       WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1
                           ORDER BY sum(l_quantity) DESC, l_partkey LIMIT 10)"""
)
def top_set_semi(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_orderkey", "l_quantity")
    sold = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"))
    return filters.in_top_set(lines, sold.orderBy(F.desc("sold"), "l_partkey").limit(10), ["l_partkey"])


# --- joins ---------------------------------------------------------------


@query(
    """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_inner(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    names = table(spark, folder, "customer").select("c_custkey", "c_name")
    return orders.join(names, "c_custkey", "inner").drop("c_custkey")


@query(
    with_views(
        ["channel", "channel_log"],
        """SELECT channel_id, view_count, name, topic FROM channel_log LEFT JOIN channel
           USING (channel_id)""",
    )
)
def join_left(spark, folder):
    log = views.channel_log(spark, folder).select("channel_id", "view_count")
    return log.join(views.channel(spark, folder).select("channel_id", "name", "topic"), "channel_id", "left")


@query(
    with_views(
        ["video", "video_log"],
        """SELECT l.video_id, v.duration, l.view_count
           FROM (SELECT * FROM video WHERE video_type = 'video') v
           RIGHT JOIN video_log l ON v.video_id = l.video_id""",
    )
)
def join_right(spark, folder):
    regular = views.video(spark, folder).where("video_type = 'video'").select("video_id", "duration")
    log = views.video_log(spark, folder).select("video_id", "view_count")
    return regular.join(log, "video_id", "right")


@query(
    """SELECT l_suppkey AS channel_id, l_returnflag AS video_type, l_partkey AS video_id
       FROM lineitem a WHERE l_linestatus = 'O' AND NOT EXISTS (
         SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_suppkey = a.l_suppkey
           AND b.l_returnflag = a.l_returnflag AND b.l_partkey = a.l_partkey)"""
)
def new_video_anti(spark, folder):
    keys = ["channel_id", "video_type", "video_id"]
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("channel_id"),
        F.col("l_returnflag").alias("video_type"),
        F.col("l_partkey").alias("video_id"),
        "l_linestatus",
    )
    found, stored = (lines.where(F.col("l_linestatus") == s).select(*keys) for s in ("O", "F"))
    return joins.not_stored(found, stored, keys)


@query(
    with_views(
        ["video", "last_channel"],
        "SELECT video_id, title, sub_count FROM video JOIN last_channel USING (channel_id)",
    )
)
def latest_lookup(spark, folder):
    video = views.video(spark, folder).select("video_id", "channel_id", "title")
    joined = joins.with_latest(video, views.channel_log(spark, folder), "channel_id", ["sub_count"])
    return joined.select("video_id", "title", "sub_count")


STAR = with_views(
    ["video", "video_log", "channel", "last_channel"],
    """SELECT l.video_id, v.channel_id, strftime(l.created_date, '%Y-%m-%d') AS created_date,
         l.view_count, v.video_type, c.name, s.sub_count
       FROM video_log l JOIN video v USING (video_id)
       LEFT JOIN channel c ON v.channel_id = c.channel_id
       LEFT JOIN last_channel s ON v.channel_id = s.channel_id""",
)


@query(STAR)
def star_join(spark, folder):
    joined = joins.star(
        views.video(spark, folder),
        views.video_log(spark, folder),
        views.channel(spark, folder),
        views.channel_log(spark, folder),
    )
    return joined.select(
        "video_id", "channel_id", "created_date", "view_count", "video_type", "name", "sub_count"
    )


@query(STAR)
def star_join_bucketed(spark, folder):
    """The same from a log stored in buckets, which is not shuffled."""
    name = f"video_log_{uuid.uuid4().hex}"
    log = writers.write_bucketed(views.video_log(spark, folder), name, scratch_path(spark, name), "video_id", 8)
    joined = joins.star(views.video(spark, folder), log, views.channel(spark, folder), views.channel_log(spark, folder))
    return joined.select("video_id", "channel_id", "created_date", "view_count", "video_type", "name", "sub_count")


@query(
    with_views(
        ["video", "video_log", "channel_log"],
        """SELECT v.video_id, v.video_type, l.view_count, c.sub_count
           FROM video_log l JOIN video v USING (video_id) JOIN channel_log c USING (channel_id)
           WHERE c.created_date = (SELECT max(created_date) FROM channel_log)""",
    )
)
def sql_cte_join(spark, folder):
    return run_sql(
        spark,
        """WITH newest AS (
             SELECT channel_id, sub_count FROM {channel_log}
             WHERE created_date = (SELECT max(created_date) FROM {channel_log})),
           described AS (
             SELECT video_id, video_type, sub_count FROM {video} JOIN newest USING (channel_id))
           SELECT video_id, video_type, view_count, sub_count
           FROM {video_log} JOIN described USING (video_id)""",
        video=views.video(spark, folder),
        video_log=views.video_log(spark, folder),
        channel_log=views.channel_log(spark, folder),
    )


@query(
    with_views(
        ["video", "video_log"],
        """SELECT video_id, duration, view_count FROM video_log JOIN video USING (video_id)
           WHERE video_type = 'video'""",
    )
)
def sql_derived_join(spark, folder):
    return run_sql(
        spark,
        """SELECT video_id, duration, view_count FROM {video_log}
           JOIN (SELECT video_id, duration FROM {video} WHERE video_type = 'video') USING (video_id)""",
        video=views.video(spark, folder),
        video_log=views.video_log(spark, folder),
    )


# --- aggregates ----------------------------------------------------------


@query("SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY 1")
def count_per_bucket(spark, folder):
    return aggregates.value_counts(table(spark, folder, "lineitem"), ["l_quantity"])


@query(
    "SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS count FROM lineitem GROUP BY 1"
)
def value_counts(spark, folder):
    days = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return aggregates.value_counts(days, ["day"])


@query(
    """SELECT l_orderkey, l_quantity, count(*) OVER (PARTITION BY l_quantity) AS count
       FROM lineitem"""
)
def group_count_joined(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    return joins.with_group_count(lines, ["l_quantity"])


@query(
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1"""
)
def mean_per_bucket(spark, folder):
    mean = F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(mean)


@query(
    """SELECT l_quantity, count(l_extendedprice) AS rows,
         round(quantile_cont(l_extendedprice, 0.5), 4) AS median
       FROM lineitem GROUP BY 1"""
)
def median_per_bin(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    medians = quantiles.medians(lines, ["l_quantity"], "l_extendedprice")
    return medians.withColumn("median", F.round("median", 4))


@query(
    with_views(
        ["channel_log"],
        """SELECT channel_id,
             arg_max(sub_count, created_date) - arg_min(sub_count, created_date) AS monthly_sub_delta,
             arg_max(view_count, created_date) - arg_min(view_count, created_date) AS monthly_view_delta,
             arg_max(video_count, created_date) - arg_min(video_count, created_date)
               AS monthly_video_delta
           FROM channel_log GROUP BY 1""",
    )
)
def monthly_delta(spark, folder):
    counters = ["sub_count", "view_count", "video_count"]
    return aggregates.period_delta(views.channel_log(spark, folder), "channel_id", counters, "monthly")


DELTAS = f"""SELECT channel_id,
      row_number() OVER w AS week_num, lead(sub_count) OVER w - sub_count AS sub_delta,
      lead(view_count) OVER w - view_count AS view_delta,
      lead(video_count) OVER w - video_count AS video_delta
    FROM channel_log WHERE created_date IN {CHECKPOINTS}
    WINDOW w AS (PARTITION BY channel_id ORDER BY created_date)"""


def _deltas(spark, folder):
    log = filters.on_days(
        views.channel_log(spark, folder), "created_date", dates.checkpoint_days(JANUARY)
    )
    return windows.checkpoint_deltas(log, "channel_id", ["sub_count", "view_count", "video_count"])


@query(with_views(["channel_log"], "SELECT * FROM deltas WHERE week_num <> 5", deltas=DELTAS))
def checkpoint_delta(spark, folder):
    return _deltas(spark, folder)


@query(
    with_views(
        ["channel_log"],
        "SELECT channel_id, "
        + ", ".join(
            f"max(CASE WHEN week_num = {n} THEN {c} END) AS \"{n}_{c}\""
            for n in range(1, 5)
            for c in ("sub_delta", "view_delta", "video_delta")
        )
        + " FROM deltas WHERE week_num <> 5 GROUP BY 1",
        deltas=DELTAS,
    )
)
def weekly_pivot(spark, folder):
    names = {c: c for c in ("sub_delta", "view_delta", "video_delta")}
    return aggregates.pivot_by_ordinal(_deltas(spark, folder), "channel_id", "week_num", 4, names)


# --- one row per key, windows and ranks ----------------------------------


@query(
    """SELECT user_id, event_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_per_key(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return dedup.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey) = 1"""
)
def dedup_first(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return dedup.first_per_key(lines, ["l_orderkey"], ["l_linenumber"])


@query(
    with_views(
        ["video_log"],
        """SELECT video_id, strftime(created_date, '%Y-%m-%d') AS created_date, view_count,
             row_number() OVER (PARTITION BY video_id ORDER BY created_date) AS ordinal
           FROM video_log""",
    )
)
def snapshot_ordinal(spark, folder):
    log = views.video_log(spark, folder).select("video_id", "created_date", "view_count")
    return windows.snapshot_ordinal(log, "video_id")


@query("SELECT event_id, value, rank() OVER (ORDER BY value DESC) AS rank FROM events")
def global_rank(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return positions.rank_rows(events, [], "value", "rank")


@query(
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
         ORDER BY o_totalprice, o_orderkey) AS place FROM orders"""
)
def rank_in_group(spark, folder):
    keys = ["o_orderpriority", "o_orderstatus"]
    orders = table(spark, folder, "orders").select(*keys, "o_totalprice", "o_orderkey")
    order = [F.asc("o_totalprice"), F.asc("o_orderkey")]
    return positions.number_rows(orders, keys, order, "place").select("o_orderkey", "place")


# --- topics --------------------------------------------------------------

TOKENS = """SELECT channel_id, unnest(string_split(replace(topic, ' ', ''), ',')) AS token
            FROM channel WHERE topic IS NOT NULL"""


@query(with_views(["channel"], "SELECT * FROM tokens", tokens=TOKENS))
def topic_tokens(spark, folder):
    tokens = F.explode(text.id_tokens(F.col("topic"))).alias("token")
    return views.channel(spark, folder).select("channel_id", tokens)


@query(with_views(["channel"], "SELECT token, count(*) AS count FROM tokens GROUP BY 1", tokens=TOKENS))
def topic_counts(spark, folder):
    return topk.topic_counts(views.channel(spark, folder))


TOP = """SELECT token AS label, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS position
         FROM tokens GROUP BY 1 ORDER BY 2 LIMIT 7"""


@query(with_views(["channel"], "SELECT position, label FROM top", tokens=TOKENS, top=TOP))
def top_topics(spark, folder):
    return topk.top_topics(views.channel(spark, folder))


@query(
    with_views(
        ["channel"],
        """SELECT channel_id, coalesce((SELECT arg_min(label, position) FROM top
             WHERE contains(topic, label)), 'Other') AS category FROM channel""",
        tokens=TOKENS,
        top=TOP,
    )
)
def topic_category(spark, folder):
    channel = views.channel(spark, folder)
    labelled = topk.with_category(channel, "topic", topk.top_topics(channel), "category")
    return labelled.select("channel_id", "category")


# --- dimensions and constraints ------------------------------------------


@query(
    with_views(
        ["channel"],
        """SELECT channel_id, name, customurl,
             strftime(published_date, '%Y-%m-%d %H:%M:%S') AS published_date, country, keywords, topic
           FROM channel""",
    )
)
def channel_dimension(spark, folder):
    return channel_dimension_plan(views.channel(spark, folder))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2
       HAVING count(*) > 1"""
)
def dq_primary_key(spark, folder):
    return quality.primary_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT p_name, count(*) AS rows FROM part GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, folder):
    return quality.unique(table(spark, folder, "part"), "p_name")


@query(
    with_views(
        ["channel"],
        """SELECT * FROM (SELECT 'country' AS "column", count(*) AS rows FROM channel
             WHERE country IS NULL UNION ALL SELECT 'topic', count(*) FROM channel
             WHERE topic IS NULL UNION ALL SELECT 'name', count(*) FROM channel WHERE name IS NULL)
           WHERE rows > 0""",
    )
)
def dq_not_null(spark, folder):
    return quality.not_null(views.channel(spark, folder), ["country", "topic", "name"])


@query(
    """SELECT * FROM (SELECT 'p_brand' AS "column", count(*) AS rows FROM part
         WHERE length(p_brand) <> 8 UNION ALL SELECT 'p_name', count(*) FROM part
         WHERE length(p_name) > 9) WHERE rows > 0"""
)
def dq_length(spark, folder):
    return quality.length(table(spark, folder, "part"), {"p_brand": 8}, {"p_name": 9})


@query(
    """SELECT o_orderstatus, count(*) AS rows FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
       GROUP BY 1"""
)
def dq_check(spark, folder):
    return quality.in_set(table(spark, folder, "orders"), "o_orderstatus", ["O", "F"])


@query(
    """SELECT l_partkey, count(*) AS rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1"""
)
def dq_foreign_key(spark, folder):
    lines, customer = (table(spark, folder, name) for name in ("lineitem", "customer"))
    return quality.foreign_key(lines, "l_partkey", customer, "c_custkey")


@query(
    """WITH log AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders)
       SELECT * FROM (
         SELECT 'video_log' AS "table", 'not null' AS "constraint", 'like_count' AS "column",
           (SELECT count(*) FROM log WHERE s = 'P') AS rows
         UNION ALL SELECT 'video_log', 'foreign key', 'video_id',
           (SELECT count(*) FROM log WHERE k NOT IN (SELECT c_custkey FROM customer)))
       WHERE rows > 0"""
)
def dq_report(spark, folder):
    log = table(spark, folder, "orders").select(
        views.video_key(F.col("o_orderkey")).alias("video_id"),
        F.col("o_custkey").alias("view_count"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("like_count"),
        F.col("o_custkey").alias("comment_count"),
    )
    return quality.report({"video": views.video(spark, folder), "video_log": log})


@query(
    """WITH documents_of_events AS (
         SELECT event_id, CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1)
           WHEN event_id % 11 = 0 THEN NULL ELSE props END AS body FROM events)
       SELECT event_id, body FROM documents_of_events WHERE NOT coalesce(json_valid(body), false)"""
)
def json_rejected(spark, folder):
    cut = F.expr("substring(props, 1, length(props) - 1)")
    body = F.when(F.col("event_id") % 7 == 0, cut).when(F.col("event_id") % 11 != 0, F.col("props"))
    return payload.rejected(table(spark, folder, "events").select("event_id", body.alias("body")))
