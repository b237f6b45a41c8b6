"""Domain tables derived from the test tables.

Every customer is a video and a channel; eight neighbouring customer keys make
up the videos of one channel. Events are what viewers did with a video, and the
logs are their running counts by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

VIDEOS_PER_CHANNEL = 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def video_key(number: Column) -> Column:
    return F.concat(F.lit("v"), F.lpad(number.cast("string"), 10, "0"))


def channel_key(number: Column) -> Column:
    return F.concat(F.lit("UC"), F.lpad(number.cast("string"), 22, "0"))


def channel_of(number: Column) -> Column:
    return channel_key(F.floor(number / VIDEOS_PER_CHANNEL))


def type_of(number: Column) -> Column:
    return F.when(number % 3 == 0, "short").otherwise("video")


def published(number: Column) -> Column:
    """Midnight of the publishing day, as a timestamp."""
    day = F.date_sub(F.lit("2024-01-25").cast("date"), ((number * 7) % 60).cast("int"))
    return day.cast("timestamp_ntz")


def seconds_of(number: Column) -> Column:
    return (number * 97) % 5400 + 30


def _log(daily: DataFrame, key: str, counters: dict[str, str]) -> DataFrame:
    by_day = Window.partitionBy(key).orderBy("day")
    return daily.select(
        key,
        *[F.sum(source).over(by_day).alias(name) for name, source in counters.items()],
        F.col("day").alias("created_date"),
        (F.col("day").cast("timestamp_ntz") + F.expr("interval 9 hours")).alias("created_at"),
    )


def _daily(spark: SparkSession, folder: str, key: str, number, kinds: list[str]) -> DataFrame:
    events = table(spark, folder, "events")
    counts = [F.count_if(F.col("event_type") == kind).alias(kind) for kind in kinds]
    return events.groupBy(number(F.col("user_id")).alias(key), F.to_date("ts").alias("day")).agg(*counts)


def video_log(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily(spark, folder, "video_id", video_key, ["view", "click", "error"])
    counters = {"view_count": "view", "like_count": "click", "comment_count": "error"}
    return _log(daily, "video_id", counters)


def channel_log(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily(spark, folder, "channel_id", channel_of, ["view", "signup", "purchase"])
    counters = {"view_count": "view", "sub_count": "signup", "video_count": "purchase"}
    return _log(daily, "channel_id", counters)


def video(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("c_custkey")
    s = seconds_of(n)
    return table(spark, folder, "customer").select(
        video_key(n).alias("video_id"),
        channel_of(n).alias("channel_id"),
        F.col("c_name").alias("title"),
        type_of(n).alias("video_type"),
        published(n).cast("date").alias("published_date"),
        (published(n) + F.make_dt_interval(hours=(n % 24).cast("int"))).alias("published_time"),
        F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60).alias(
            "duration"
        ),
        F.concat(F.lit("https://img.example.net/"), video_key(n)).alias("thumbnail_url"),
        F.col("c_mktsegment").alias("tags"),
        F.col("c_nationkey").cast("smallint").alias("categoryid"),
        (n % 5 != 0).alias("active"),
    )


def channel(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("c_custkey")
    part = table(spark, folder, "part")
    topic = F.when(F.col("p_size") > 2, F.replace("p_name", F.lit(" "), F.lit(", ")))
    return (
        table(spark, folder, "customer")
        .join(part, F.col("p_partkey") == n, "left")
        .select(
            channel_key(n).alias("channel_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("@"), F.lower("c_name")).alias("customurl"),
            published(n).alias("published_date"),
            F.when(F.col("c_nationkey") > 0, F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias(
                "country"
            ),
            F.col("p_brand").alias("keywords"),
            topic.alias("topic"),
            (F.col("c_acctbal") >= 0).alias("active"),
        )
    )


def _document(item: Column) -> Column:
    """A list response as JSON text. Null fields are left out, as in stored documents."""
    return F.to_json(F.struct(F.array(item).alias("items")))


def channel_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(channel_id, body): one channel document per customer."""
    n = F.col("c_custkey")
    part = table(spark, folder, "part")
    url = F.lit("https://topics.example.org/wiki/")
    topics = F.transform(F.split("p_name", " "), lambda word: F.concat(url, word))
    item = F.struct(
        channel_key(n).alias("id"),
        F.struct(
            F.col("c_name").alias("title"),
            F.when(n % 4 != 0, F.concat(F.lit("@"), F.lower("c_name"))).alias("customUrl"),
            F.date_format(published(n), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.struct(
                F.struct(F.concat(F.lit("https://img.example.net/"), channel_key(n)).alias("url")).alias(
                    "high"
                )
            ).alias("thumbnails"),
        ).alias("snippet"),
        F.struct(
            F.round(F.abs("c_acctbal") * 100).cast("long").cast("string").alias("viewCount"),
            n.cast("string").alias("subscriberCount"),
            F.col("c_nationkey").cast("string").alias("videoCount"),
        ).alias("statistics"),
        F.when(F.col("p_size") > 2, F.struct(topics.alias("topicCategories"))).alias("topicDetails"),
        F.struct(
            F.struct(
                F.col("c_mktsegment").alias("description"),
                F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("keywords"),
                F.when(F.col("c_nationkey") > 0, F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias(
                    "country"
                ),
            ).alias("channel")
        ).alias("brandingSettings"),
    )
    customers = table(spark, folder, "customer").join(part, F.col("p_partkey") == n, "left")
    return customers.select(channel_key(n).alias("channel_id"), _document(item).alias("body"))


def video_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, video_type, body): one video document per customer."""
    n = F.col("c_custkey")
    s = seconds_of(n)
    item = F.struct(
        video_key(n).alias("id"),
        F.struct(
            F.date_format(
                published(n) + F.make_dt_interval(hours=(n % 24).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'"
            ).alias("publishedAt"),
            F.col("c_name").alias("title"),
            F.col("c_mktsegment").alias("description"),
            F.struct(
                F.struct(F.concat(F.lit("https://img.example.net/"), video_key(n)).alias("url")).alias(
                    "high"
                )
            ).alias("thumbnails"),
            F.when(n % 2 == 0, F.array(F.col("c_mktsegment"), F.lit("clip"))).alias("tags"),
            F.when(n % 7 != 0, F.col("c_nationkey").cast("string")).alias("categoryId"),
        ).alias("snippet"),
        F.struct(
            F.concat(
                F.lit("PT"),
                F.when(s >= 3600, F.concat(F.floor(s / 3600), F.lit("H"))).otherwise(""),
                F.floor(s / 60) % 60,
                F.lit("M"),
                F.when(s % 60 > 0, F.concat(s % 60, F.lit("S"))).otherwise(""),
            ).alias("duration")
        ).alias("contentDetails"),
        F.struct(
            F.round(F.abs("c_acctbal") * 100).cast("long").cast("string").alias("viewCount"),
            F.when(n % 3 != 0, n.cast("string")).alias("likeCount"),
            F.when(n % 5 != 0, F.col("c_nationkey").cast("string")).alias("commentCount"),
        ).alias("statistics"),
    )
    return table(spark, folder, "customer").select(
        video_key(n).alias("video_id"), type_of(n).alias("video_type"), _document(item).alias("body")
    )


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(channel_id, video_type, page_no, body): listing pages of at most four ids.

    A channel has eight neighbouring customer keys, so a page text is put
    together from at most four of them. Page 0 and its continuation use the two
    stored forms; the last page has no continuation token.
    """
    n = F.col("c_custkey")
    half = (F.floor(n / (VIDEOS_PER_CHANNEL // 2)) % 2).cast("int")
    ids = F.array_sort(F.collect_list(video_key(n)))
    first = F.transform("ids", lambda i: F.concat(F.lit('"Endpoint":{"videoId":"'), i, F.lit('",')))
    later = F.transform(
        "ids", lambda i: F.concat(F.lit('"videoRenderer": {\n "videoId": "'), i, F.lit('",'))
    )
    token = F.lit('"continuationCommand":{"token":"next",')
    body = F.when(F.col("page_no") == 0, F.concat(F.array_join(first, "\n"), token)).otherwise(
        F.array_join(later, "\n")
    )
    return (
        table(spark, folder, "customer")
        .groupBy(
            channel_of(n).alias("channel_id"), type_of(n).alias("video_type"), half.alias("page_no")
        )
        .agg(ids.alias("ids"))
        .select("channel_id", "video_type", "page_no", body.alias("body"))
    )


def channel_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(channel_id, body): a channel page per supplier with two or three tabs and a key."""
    titles = F.array_compact(
        F.array(
            F.lit("Home"),
            F.lit("Videos"),
            F.when(F.col("s_nationkey") % 2 == 0, F.lit("Shorts")),
        )
    )
    tabs = F.transform(
        titles,
        lambda title: F.concat(
            F.lit('{"tabRenderer":{"endpoint":{"meta":{"web":{}},"browse":{}},"title":"'), title, F.lit('"}}')
        ),
    )
    key = F.concat(F.lit('"INNERTUBE_API_KEY":"key-'), F.col("s_suppkey"), F.lit('",'))
    return table(spark, folder, "supplier").select(
        channel_key(F.col("s_suppkey")).alias("channel_id"),
        F.concat(F.array_join(tabs, ","), F.lit("\n"), key).alias("body"),
    )


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, body): a search page with two hits per part."""
    hit = F.concat(
        F.lit('"channelId":"'), channel_key(F.col("p_partkey")), F.lit('","title":{"simpleText":"'),
        F.col("p_name"), F.lit('"}'),
    )
    second = F.concat(
        F.lit('"channelId":"'), F.col("p_brand"), F.lit('","title":{"simpleText":"'),
        F.col("p_type"), F.lit('"}'),
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_id"), F.concat_ws("\n", hit, second).alias("body")
    )
