"""Composite jobs: star schema, analyses, ingest, page parsing, sinks and streaming."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from viewtide import schema
from viewtide.functions import payload
from viewtide.plans import (
    channel_distribution as distribution,
    daily,
    duration_trend,
    ingest,
    monthly_channel_fact as monthly,
    pages,
    video_fact as videos,
    view_sub_ratio as view_sub,
)
from viewtide.plans.extract import extract
from viewtide.session import scratch_path, settled
from viewtide.sources import readers, records, writers
from viewtide.streaming import snapshots
from workload import views
from workload.basics import CHECKPOINTS
from workload.registry import query, with_views
from workload.views import table

AS_OF = dt.date(2024, 2, 15)

# --- star schema ---------------------------------------------------------

WEEKLY = ", ".join(
    f'max(CASE WHEN week_num = {n} THEN {c}_delta END) AS "{n}_{c}_delta"'
    for n in range(1, 5)
    for c in ("sub", "view", "video")
)


MONTHLY = with_views(
    ["channel_log"],
    """SELECT *, rank() OVER (ORDER BY monthly_sub_delta DESC) AS sub_ranking,
         rank() OVER (ORDER BY monthly_view_delta DESC) AS view_ranking
       FROM weekly JOIN totals USING (channel_id)""",
    deltas=f"""SELECT channel_id, row_number() OVER w AS week_num,
          lead(sub_count) OVER w - sub_count AS sub_delta,
          lead(view_count) OVER w - view_count AS view_delta,
          lead(video_count) OVER w - video_count AS video_delta
        FROM channel_log WHERE created_date IN {CHECKPOINTS}
        WINDOW w AS (PARTITION BY channel_id ORDER BY created_date)""",
    weekly=f"SELECT channel_id, {WEEKLY} FROM deltas WHERE week_num <> 5 GROUP BY 1",
    totals="""SELECT channel_id,
          arg_max(sub_count, created_date) - arg_min(sub_count, created_date)
            AS monthly_sub_delta,
          arg_max(view_count, created_date) - arg_min(view_count, created_date)
            AS monthly_view_delta,
          arg_max(video_count, created_date) - arg_min(video_count, created_date)
            AS monthly_video_delta
        FROM channel_log
        WHERE created_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1""",
)


@query(MONTHLY)
def monthly_channel_fact(spark, folder):
    return monthly.monthly_channel_fact(views.channel_log(spark, folder), AS_OF)


@query(MONTHLY)
def monthly_fact_refresh(spark, folder):
    """A third of the month at a time, the second one twice."""
    log = views.channel_log(spark, folder)
    day = F.dayofmonth("created_date")
    parts = [log.where(day <= 10), log.where(day.between(11, 20)), log.where(day.between(11, 20)), log.where(day > 20)]
    held = None
    for part in parts:
        new = monthly.month_partials(part)
        held = settled(new if held is None else monthly.merged_partials(held, new))
    return monthly.ranked(monthly.growth_of(held, AS_OF))


SNAPSHOTS = 30
PIVOT = ", ".join(
    f"""max(CASE WHEN n = {n} THEN strftime(created_date, '%Y-%m-%d') END) AS "{n}_date",
        max(CASE WHEN n = {n} THEN view_count END) AS "{n}_view",
        max(CASE WHEN n = {n} THEN comment_count END) AS "{n}_comment",
        max(CASE WHEN n = {n} THEN like_count END) AS "{n}_like\""""
    for n in range(1, SNAPSHOTS + 1)
)
NUMBERED = """SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY created_date) AS n
              FROM video_log"""
COUNTS = tuple(f"{n}_{c}" for n in range(1, SNAPSHOTS + 1) for c in ("view", "comment", "like"))
WIDE = f"SELECT video_id, {PIVOT} FROM numbered GROUP BY 1"


@query(with_views(["video_log"], "SELECT * FROM wide", numbered=NUMBERED, wide=WIDE), COUNTS)
def snapshot_pivot(spark, folder):
    return videos.snapshots_wide(views.video_log(spark, folder), SNAPSHOTS)


@query(
    with_views(
        ["video", "video_log", "last_channel"],
        """SELECT v.title, v.channel_id, v.video_type,
             strftime(v.published_time, '%Y-%m-%d %H:%M:%S') AS published_time,
             round(v.seconds / 60.0, 6) AS duration, wide.*, c.sub_count,
             row_number() OVER (PARTITION BY v.channel_id, v.video_type
               ORDER BY "30_view" NULLS FIRST, v.video_id) AS video_ranking,
             trunc("30_view" / 6)::BIGINT AS avg_daily_view,
             trunc("30_view" / nullif(c.sub_count, 0))::BIGINT AS sub_view_ratio
           FROM video v JOIN wide USING (video_id) JOIN last_channel c USING (channel_id)""",
        numbered=NUMBERED,
        wide=WIDE,
    ),
    nullable=(*COUNTS, "avg_daily_view", "sub_view_ratio"),
)
def video_fact(spark, folder):
    fact = videos.video_fact(
        views.video(spark, folder), views.video_log(spark, folder), views.channel_log(spark, folder)
    )
    return fact.withColumn("duration", F.round("duration", 6))


# --- analyses ------------------------------------------------------------

LABELS = {
    "tokens": """SELECT unnest(string_split(replace(topic, ' ', ''), ',')) AS token FROM latest""",
    "top": """SELECT token AS label, row_number() OVER (ORDER BY count(*) DESC, token) AS position
              FROM tokens GROUP BY 1 ORDER BY 2 LIMIT 7""",
}
LABELLED = """SELECT channel_id, name, view_count, sub_count, video_count,
    strftime(created_date, '%Y-%m-%d') AS created_date,
    coalesce((SELECT arg_min(label, position) FROM top WHERE contains(topic, label)), 'Other') AS topic
  FROM latest"""
LATEST_COLUMNS = [
    "channel_id", "name", "view_count", "sub_count", "video_count", "created_date", "topic",
]


@query(
    with_views(
        ["channel", "last_channel"],
        LABELLED,
        latest="""SELECT l.*, name, topic FROM last_channel l JOIN channel USING (channel_id)
                  WHERE name IS NOT NULL AND topic IS NOT NULL""",
        **LABELS,
    )
)
def channel_distribution(spark, folder):
    result = distribution.channel_distribution(
        views.channel(spark, folder), views.channel_log(spark, folder)
    )
    return result.select(*LATEST_COLUMNS)


@query(
    with_views(
        ["channel", "last_channel"],
        LABELLED,
        latest="""SELECT l.*, coalesce(name, 'NULL') AS name, coalesce(topic, 'NULL') AS topic
                  FROM last_channel l LEFT JOIN channel USING (channel_id)""",
        **LABELS,
    )
)
def channel_distribution_fill(spark, folder):
    result = distribution.channel_distribution(
        views.channel(spark, folder), views.channel_log(spark, folder), nulls="fill"
    )
    return result.select(*LATEST_COLUMNS)


AGED = """SELECT l.video_id, l.view_count, v.channel_id, v.seconds
          FROM last_video l JOIN video v USING (video_id)
          WHERE v.video_type = 'video' AND l.created_date - v.published_date"""


@query(
    with_views(
        ["video", "last_video"],
        """SELECT seconds // 60 AS duration_minute, count(*) AS count,
             round(avg(view_count), 6) AS avg_view_count
           FROM aged WHERE seconds < 3600 GROUP BY 1 HAVING count(*) > 1""",
        aged=AGED + " >= 7",
    )
)
def duration_trend_minute(spark, folder):
    trend = duration_trend.by_minute(
        views.video(spark, folder), views.video_log(spark, folder), more_than=1
    )
    return trend.withColumn("avg_view_count", F.round("avg_view_count", 6))


@query(
    with_views(
        ["video", "last_video"],
        """SELECT greatest(1, least(20, ceil((minutes - low) / ((high - low) / 20.0))))::INTEGER AS bin,
             count(*) AS count, round(quantile_cont(view_count, 0.5), 6) AS median_view_count
           FROM frequent, (SELECT min(minutes) AS low, max(minutes) AS high FROM frequent)
           GROUP BY 1""",
        aged=AGED + " >= 7",
        minutes="""SELECT ceil(seconds / 60.0)::INTEGER AS minutes, view_count FROM aged
                   WHERE ceil(seconds / 60.0) < 60""",
        frequent="""SELECT * FROM minutes
                    WHERE minutes IN (SELECT minutes FROM minutes GROUP BY 1 HAVING count(*) > 1)""",
    )
)
def duration_histogram(spark, folder):
    bins = duration_trend.by_bin(views.video(spark, folder), views.video_log(spark, folder), more_than=1)
    return bins.select("bin", "count", F.round("median_view_count", 6).alias("median_view_count"))


RATIOS = """SELECT video_id, name, sub_count, view_count,
              view_count / nullif(sub_count, 0) AS view_sub_ratio
            FROM aged JOIN channel USING (channel_id) LEFT JOIN last_channel USING (channel_id)"""
RATIOS = RATIOS.replace("view_count,\n", "aged.view_count,\n").replace(
    "view_count / nullif", "aged.view_count / nullif"
)
TOP_CHANNELS = """SELECT name, avg(view_sub_ratio) AS avg_view_sub_ratio, avg(sub_count) AS sub_count
                  FROM ratios GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


def _ratio_tables(spark, folder):
    old = view_sub.old_views(views.video(spark, folder), views.video_log(spark, folder))
    subs = view_sub.subscribers(views.channel(spark, folder), views.channel_log(spark, folder))
    return old, subs


@query(
    with_views(
        ["video", "last_video", "channel", "last_channel"],
        """SELECT video_id, name, sub_count, view_count, round(view_sub_ratio, 6) AS view_sub_ratio
           FROM ratios""",
        aged=AGED + " > 30",
        ratios=RATIOS,
    )
)
def view_sub_ratio(spark, folder):
    ratios = view_sub.video_ratios(*_ratio_tables(spark, folder))
    rounded = F.round("view_sub_ratio", 6).alias("view_sub_ratio")
    return ratios.select("video_id", "name", "sub_count", "view_count", rounded)


@query(
    with_views(
        ["video", "last_video", "channel", "last_channel"],
        """SELECT name, round(avg_view_sub_ratio, 6) AS avg_view_sub_ratio,
             round(sub_count, 6) AS sub_count FROM top""",
        aged=AGED + " > 30",
        ratios=RATIOS,
        top=TOP_CHANNELS,
    )
)
def view_sub_top10(spark, folder):
    top = view_sub.top_channels(*_ratio_tables(spark, folder), view_sub.EXCLUDED)
    return top.select("name", *[F.round(c, 6).alias(c) for c in ("avg_view_sub_ratio", "sub_count")])


BOX = ["avg_view_sub_ratio", "sub_count", "lowest", "q1", "median", "q3", "highest"]
BOX += ["lower_whisker", "upper_whisker"]


@query(
    with_views(
        ["video", "last_video", "channel", "last_channel"],
        "SELECT name, rows, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in BOX)
        + """ FROM top LEFT JOIN box USING (name) LEFT JOIN (
               SELECT name, min(view_sub_ratio) AS lower_whisker, max(view_sub_ratio) AS upper_whisker
               FROM ratios JOIN box USING (name)
               WHERE view_sub_ratio BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
               GROUP BY 1) USING (name)""",
        aged=AGED + " > 30",
        ratios=RATIOS,
        top=TOP_CHANNELS,
        box="""SELECT name, count(view_sub_ratio) AS rows, min(view_sub_ratio) AS lowest,
                 quantile_cont(view_sub_ratio, 0.25) AS q1, quantile_cont(view_sub_ratio, 0.5) AS median,
                 quantile_cont(view_sub_ratio, 0.75) AS q3, max(view_sub_ratio) AS highest
               FROM ratios WHERE view_sub_ratio IS NOT NULL GROUP BY 1""",
    )
)
def ratio_box_stats(spark, folder):
    spread = view_sub.ratio_spread(*_ratio_tables(spark, folder), view_sub.EXCLUDED)
    return spread.select("name", "rows", *[F.round(c, 6).alias(c) for c in BOX])


# --- payload documents ---------------------------------------------------


@query(
    """SELECT event_id, nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '')::BIGINT AS k,
         NULL::VARCHAR AS absent FROM events"""
)
def json_optional_keys(spark, folder):
    parsed = F.from_json("props", "k long, absent string")
    return table(spark, folder, "events").select("event_id", parsed["k"].alias("k"), parsed["absent"].alias("absent"))


@query(
    with_views(
        ["channel"],
        """SELECT c.channel_id, name,
             CASE WHEN c_custkey % 4 <> 0 THEN customurl END AS customurl,
             strftime(published_date, '%Y-%m-%dT%H:%M:%SZ') AS published_date,
             'https://img.example.net/' || channel_id AS thumbnail_url,
             c_mktsegment AS description, country,
             CASE WHEN p_size % 2 = 0 THEN p_brand END AS keywords, topic
           FROM channel c JOIN customer ON c_name = name LEFT JOIN part ON p_partkey = c_custkey""",
    )
)
def json_channel_info(spark, folder):
    return payload.channel_info(views.channel_documents(spark, folder))


VIDEO_INFO = """SELECT v.video_id, v.video_type, v.title, v.tags AS description, v.thumbnail_url,
    CASE WHEN c_custkey % 7 <> 0 THEN categoryid END AS categoryid,
    CASE WHEN c_custkey % 2 = 0 THEN v.tags || ', clip' END AS tags"""


@query(
    with_views(
        ["video"],
        VIDEO_INFO.replace("THEN categoryid END", "THEN categoryid::VARCHAR END")
        + """, strftime(published_time, '%Y-%m-%dT%H:%M:%SZ') AS published_date,
             'PT' || CASE WHEN seconds >= 3600 THEN (seconds // 3600)::VARCHAR || 'H' ELSE '' END
               || ((seconds // 60) % 60)::VARCHAR || 'M'
               || CASE WHEN seconds % 60 > 0 THEN (seconds % 60)::VARCHAR || 'S' ELSE '' END AS duration
           FROM video v""",
    )
)
def json_video_info(spark, folder):
    return payload.video_info(views.video_documents(spark, folder))


@query(
    """SELECT 'UC' || lpad(c_custkey::VARCHAR, 22, '0') AS channel_id,
         round(abs(c_acctbal) * 100)::BIGINT AS view_count, c_custkey AS sub_count,
         c_nationkey::BIGINT AS video_count, '2024-02-15' AS created_date FROM customer"""
)
def channel_stat_ingest(spark, folder):
    return ingest.channel_snapshot(views.channel_documents(spark, folder), AS_OF)


@query(
    """SELECT 'v' || lpad(c_custkey::VARCHAR, 10, '0') AS video_id,
         round(abs(c_acctbal) * 100)::BIGINT AS view_count,
         CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS like_count,
         c_nationkey::BIGINT AS comment_count, '2024-02-15' AS created_date
       FROM customer WHERE c_custkey % 5 <> 0""",
    nullable=("like_count",),
)
def video_stat_ingest(spark, folder):
    return ingest.video_snapshot(
        views.video(spark, folder), views.video_documents(spark, folder), AS_OF
    )


LISTED = """SELECT channel_id, video_type, video_id, page_no, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY channel_id, video_type
                                 ORDER BY page_no, pos) AS place
    FROM (SELECT channel_id, video_type, video_id, ((c_custkey // 4) % 2)::INTEGER AS page_no,
            row_number() OVER (PARTITION BY channel_id, video_type, c_custkey // 4
                               ORDER BY video_id) - 1 AS pos
          FROM video)) WHERE place <= 3"""


@query(with_views(["video"], "SELECT * FROM listed", listed=LISTED))
def listing_cap(spark, folder):
    return pages.listing(views.listing_pages(spark, folder), limit=3)


@query(
    with_views(
        ["video"],
        VIDEO_INFO
        + """, v.channel_id, strftime(published_time + INTERVAL 8 HOUR, '%Y-%m-%d') AS published_date,
             strftime(published_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS published_time, duration
           FROM video v JOIN listed USING (video_id)
           WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""",
        listed=LISTED,
    ),
    nullable=("categoryid",),
)
def ingest_new_videos(spark, folder):
    events = table(spark, folder, "events").where("event_type = 'error'")
    number = F.col("user_id")
    stored = events.select(
        views.channel_of(number).alias("channel_id"),
        views.type_of(number).alias("video_type"),
        views.video_key(number).alias("video_id"),
    ).distinct()
    listed = pages.listing(views.listing_pages(spark, folder), limit=3)
    return ingest.new_videos(listed, stored, views.video_documents(spark, folder))


@query(
    with_views(
        ["channel"],
        """SELECT c.channel_id, name, topic, country FROM channel c JOIN customer ON c_name = name
           WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    )
)
def register_channels(spark, folder):
    ids = table(spark, folder, "orders").select(views.channel_key(F.col("o_custkey")).alias("channel_id"))
    found = ingest.registered_channels(ids, views.channel_documents(spark, folder))
    return found.select("channel_id", "name", "topic", "country")


@query(
    """SELECT 'read' AS kind, count(*) AS documents FROM customer WHERE c_custkey % 5 <> 0
       UNION ALL SELECT 'kept', count(*) FROM customer WHERE c_custkey % 5 = 0"""
)
def rejected_documents(spark, folder):
    """Every fifth document is cut short. The daily run stores it."""
    path = scratch_path(spark, "daily")
    documents = views.channel_documents(spark, folder)
    number = F.substring("channel_id", 3, 22).cast("long")
    body = F.when(number % 5 == 0, F.substring("body", 1, 40)).otherwise(F.col("body"))
    read = daily.append_channel_counters(documents.withColumn("body", body), AS_OF, f"{path}/log", f"{path}/rejected")
    kept = spark.read.parquet(f"{path}/rejected").groupBy().agg(F.count("*").alias("documents"))
    counts = spark.createDataFrame([("read", read)], "kind string, documents long")
    return counts.unionByName(kept.select(F.lit("kept").alias("kind"), "documents"))


# --- pages ---------------------------------------------------------------


@query(
    """SELECT page_id, page_no, generate_subscripts(ids, 1) - 1 AS pos, unnest(ids) AS video_id
       FROM (SELECT page_id, 0 AS page_no, regexp_extract_all(html, 'href="(.*?)"', 1) AS ids
             FROM pages)"""
)
def html_extract_ids(spark, folder):
    stored = table(spark, folder, "pages").withColumn("page_no", F.lit(0))
    return pages.listed_ids(stored, ["page_id", "page_no"], "html", first_page='href="(.*?)"')


@query(
    """SELECT page_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS channel_id, unnest(b) AS name
       FROM (SELECT page_id, regexp_extract_all(html, '<a href="(.*?)">(.*?)</a>', 1) AS a,
               regexp_extract_all(html, '<a href="(.*?)">(.*?)</a>', 2) AS b FROM pages)"""
)
def html_extract_pairs(spark, folder):
    link = '<a href="(.*?)">(.*?)</a>'
    return pages.search_hits(table(spark, folder, "pages"), ["page_id"], "html", link)


@query(
    """SELECT p_partkey AS page_id, 0 AS pos, 'UC' || lpad(p_partkey::VARCHAR, 22, '0') AS channel_id,
         p_name AS name FROM part
       UNION ALL SELECT p_partkey, 1, p_brand, p_type FROM part"""
)
def html_search_hits(spark, folder):
    return pages.search_hits(views.search_pages(spark, folder), ["page_id"])


@query(
    """SELECT 'UC' || lpad(s_suppkey::VARCHAR, 22, '0') AS channel_id, pos, tab FROM supplier,
         (VALUES (0, 'Home'), (1, 'Videos'), (2, 'Shorts')) AS t(pos, tab)
       WHERE pos < 2 OR s_nationkey % 2 = 0"""
)
def html_extract_tabs(spark, folder):
    return pages.channel_tabs(views.channel_pages(spark, folder), ["channel_id"])


@query(
    """SELECT 'UC' || lpad(s_suppkey::VARCHAR, 22, '0') AS channel_id, 'key-' || s_suppkey AS api_key
       FROM supplier"""
)
def html_extract_key(spark, folder):
    return pages.api_key(views.channel_pages(spark, folder), ["channel_id"])


@query(
    """SELECT 'UC' || lpad((c_custkey // 8)::VARCHAR, 22, '0') AS channel_id,
         CASE WHEN c_custkey % 3 = 0 THEN 'short' ELSE 'video' END AS video_type,
         ((c_custkey // 4) % 2)::INTEGER AS page_no,
         CASE WHEN (c_custkey // 4) % 2 = 0 THEN 'next' ELSE '' END AS token
       FROM customer GROUP BY ALL"""
)
def html_next_token(spark, folder):
    keys = ["channel_id", "video_type", "page_no"]
    return views.listing_pages(spark, folder).select(*keys, pages.page_token().alias("token"))


@query(with_views(["video"], "SELECT * FROM listed", listed=LISTED))
def listing_linked(spark, folder):
    """Pages without numbers, which say by which token they were asked for."""
    pages_ = views.listing_pages(spark, folder)
    asked = pages_.withColumn("requested", F.when(F.col("page_no") > 0, "next")).drop("page_no")
    return pages.listing(pages.linked(asked.repartition(5)), limit=3)


# --- sinks and updates ---------------------------------------------------


@query(
    with_views(
        ["video", "video_log", "channel", "channel_log"],
        """SELECT 'video' AS name, count(*) AS rows, count(DISTINCT video_id) AS keys FROM video
           UNION ALL SELECT 'video_log', count(*), count(DISTINCT video_id) FROM video_log
           UNION ALL SELECT 'channel', count(*), count(DISTINCT channel_id) FROM channel
           UNION ALL SELECT 'channel_log', count(*), count(DISTINCT channel_id) FROM channel_log""",
    )
)
def extract_roundtrip(spark, folder):
    names = ["video", "video_log", "channel", "channel_log"]
    tables = dict(zip(names, (getattr(views, name)(spark, folder) for name in names)))
    paths = extract(tables, scratch_path(spark, "extract"))
    counts = None
    for name, path in paths.items():
        key = "video_id" if name.startswith("video") else "channel_id"
        keys = readers.read_parquet(spark, path).groupBy(key).agg(F.count("*").alias("n"))
        count = keys.agg(F.sum("n").alias("rows"), F.count("*").alias("keys"))
        count = count.select(F.lit(name).alias("name"), "rows", "keys")
        counts = count if counts is None else counts.unionByName(count)
    return counts


@query("SELECT doc_id, md5(text) AS digest, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    documents = table(spark, folder, "documents")
    writers.write_csv(documents, path)
    back = readers.read_csv(spark, path, documents.schema, multi_line=True)
    return back.select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


@query(
    """SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS number, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name,
         CASE WHEN c_custkey % 7 = 0 THEN 'x' || c_custkey || ',"' || c_name || '
,"' END AS bad FROM customer""",
    nullable=("number",),
)
def csv_rejected(spark, folder):
    """Rows that fit beside the text of those that do not, with line feeds in fields."""
    path = scratch_path(spark, "csv")
    number = F.col("c_custkey").cast("string")
    number = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("x"), number)).otherwise(number)
    name = F.concat("c_name", F.lit("\n,"))
    writers.write_csv(table(spark, folder, "customer").select(number.alias("number"), name.alias("name")), path)
    found = records.read_csv_records(spark, path, "number long, name string", rejected="bad")
    good, bad = records.sorted_out(found, "bad")
    good = good.select("number", F.regexp_replace("name", "\n,", "").alias("name"), F.lit(None).cast("string").alias("bad"))
    return good.unionByName(bad.selectExpr("cast(null AS bigint) AS number", "cast(null AS string) AS name", "bad"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_infer(spark, folder):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, folder, "customer"), path)
    return readers.read_csv_inferred(spark, path)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def export_query(spark, folder):
    path = scratch_path(spark, "export")
    writers.export_csv(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F'",
        path,
        orders=table(spark, folder, "orders"),
    )
    return readers.read_csv(spark, path, "o_orderkey long, o_custkey long, o_totalprice double")


@query(
    with_views(
        ["video"], "SELECT channel_id, count(*) AS videos, max(title) AS last FROM video GROUP BY 1"
    )
)
def partitioned_checkpoint(spark, folder):
    path = scratch_path(spark, "by-channel")
    columns = views.video(spark, folder).select("channel_id", "video_id", "title")
    writers.write_by_key(columns, path, "channel_id")
    stored = readers.read_parquet(spark, path)
    return stored.groupBy("channel_id").agg(F.count("*").alias("videos"), F.max("title").alias("last"))


@query(
    with_views(
        ["video_log"],
        """SELECT video_id, view_count, like_count, comment_count,
             strftime(created_date, '%Y-%m-%d') AS created_date FROM video_log
           UNION ALL SELECT video_id, view_count, like_count, 0, '2024-02-15' FROM (
             SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY created_date DESC) AS n
             FROM video_log) WHERE n = 1""",
    )
)
def append_log(spark, folder):
    path = scratch_path(spark, "log")
    log = views.video_log(spark, folder)
    writers.append(log, path, schema.VIDEO_LOG, schema.LOG_DEFAULTS, "created_date")
    latest = log.groupBy("video_id").agg(
        F.max("like_count").alias("like_count"), F.max("view_count").alias("view_count")
    )
    new = latest.withColumn("created_date", F.lit(AS_OF))
    defaults = {**schema.LOG_DEFAULTS, "created_at": F.current_timestamp()}
    writers.append(new, path, schema.VIDEO_LOG, defaults, "created_date")
    stored = spark.read.schema(schema.VIDEO_LOG).parquet(path)
    return stored.drop("created_at")


def _stored(spark, name, rows):
    """A new catalog table of the rows, and the folder for its versions."""
    path = scratch_path(spark, name)
    rows.write.parquet(f"{path}/first")
    stored = f"{name}_{uuid.uuid4().hex}"
    spark.catalog.createTable(stored, f"{path}/first", "parquet")
    return stored, path


@query(
    with_views(
        ["video"],
        """SELECT video_id, strftime(published_date, '%Y-%m-%d') AS published_date,
             active AND published_date >= DATE '2024-01-16' AS active FROM video""",
    )
)
def expire_active(spark, folder):
    video = views.video(spark, folder).select("video_id", "published_date", "active")
    name, versions = _stored(spark, "video", video)
    daily.expire(spark, name, versions, AS_OF)
    return spark.table(name)


@query(
    with_views(
        ["video"],
        """SELECT video_id, strftime(published_date, '%Y-%m-%d') AS published_date,
             active AND published_date >= DATE '2024-01-16' AS active FROM video""",
    )
)
def expire_partitioned(spark, folder):
    path = scratch_path(spark, "video")
    video = views.video(spark, folder).select("video_id", "published_date", "active")
    writers.write_table(video, path, "published_date")
    daily.expire_partitioned(spark, path, AS_OF)
    return readers.read_parquet(spark, path).select("video_id", "published_date", "active")


@query(
    with_views(
        ["video"],
        "SELECT run, count(*) AS videos FROM listed, (VALUES (1), (2)) AS t(run) WHERE run = 1 GROUP BY 1"
        " UNION ALL SELECT 2, 0",
        listed=LISTED,
    )
)
def daily_crawl(spark, folder):
    """Two rounds over the same listings: the second one finds nothing new."""
    path = scratch_path(spark, "stored")
    spark.createDataFrame([], schema.VIDEO).write.parquet(path)
    channel = views.video(spark, folder).select("channel_id").distinct()
    name, versions = _stored(spark, "channel", channel.withColumn("active", F.lit(False)))
    listed, documents = views.listing_pages(spark, folder), views.video_documents(spark, folder)
    counts = [daily.crawl(spark, name, versions, listed, documents, path, limit=3) for _ in range(2)]
    return spark.createDataFrame(list(enumerate(counts, 1)), "run int, videos long")


@query(
    """SELECT o_custkey AS channel_id, false AS active FROM orders GROUP BY 1
       UNION ALL SELECT c_custkey, true FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def restart_marks(spark, folder):
    channel = table(spark, folder, "customer").select(F.col("c_custkey").alias("channel_id"))
    name, versions = _stored(spark, "channel", channel.withColumn("active", F.lit(False)))
    daily.set_marks(spark, name, versions)
    done = table(spark, folder, "orders").select(F.col("o_custkey").alias("channel_id"))
    daily.clear_marks(spark, name, versions, done)
    return spark.table(name)


@query(
    """SELECT c_custkey::VARCHAR AS channel_id FROM customer"""
)
def id_list_parse(spark, folder):
    path = scratch_path(spark, "ids")
    keys = table(spark, folder, "customer").select(F.col("c_custkey").cast("string"))
    keys.write.option("lineSep", ", ").text(path)
    return readers.read_id_list(spark, path)


@query("SELECT event_id, least(value, 10.0) AS value FROM events")
def update_where(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return writers.updated(events, F.col("value") > 10, {"value": F.lit(10.0)})


# --- streaming -----------------------------------------------------------


def _arriving(spark, folder):
    """Every event as a repeated report of its day."""
    stream = spark.readStream.schema(table(spark, folder, "events").schema)
    # The pattern fits a single file as well as a folder of that name.
    return stream.parquet(f"{folder}/events.parquet*").select(
        F.col("user_id").alias("video_id"), F.to_date("ts").alias("created_date")
    )


DAYS = "SELECT DISTINCT user_id AS video_id, strftime(ts, '%Y-%m-%d') AS created_date FROM events"


@query(DAYS)
def stream_snapshot_ingest(spark, folder):
    path = scratch_path(spark, "stream")
    stream = _arriving(spark, folder)
    snapshots.ingest(stream, f"{path}/log", f"{path}/progress", "video_id").awaitTermination()
    return spark.read.parquet(f"{path}/log")


@query(DAYS)
def stream_drop_repeats(spark, folder):
    path = scratch_path(spark, "stream")
    single = snapshots.without_repeats(_arriving(spark, folder), "video_id", "366 days")
    writer = single.writeStream.option("checkpointLocation", f"{path}/progress")
    writer.trigger(availableNow=True).start(f"{path}/log").awaitTermination()
    return spark.read.parquet(f"{path}/log")
