"""Queries with the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from viewtide.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The tables of ``views.py`` in SQL, each with those it is made from.
VIEWS = {
    "video_daily": (
        [],
        """SELECT 'v' || lpad(user_id::VARCHAR, 10, '0') AS video_id, ts::DATE AS day,
             count(*) FILTER (WHERE event_type = 'view') AS views,
             count(*) FILTER (WHERE event_type = 'click') AS clicks,
             count(*) FILTER (WHERE event_type = 'error') AS errors
           FROM events GROUP BY ALL""",
    ),
    "video_log": (
        ["video_daily"],
        """SELECT video_id, (sum(views) OVER w)::BIGINT AS view_count,
             (sum(clicks) OVER w)::BIGINT AS like_count,
             (sum(errors) OVER w)::BIGINT AS comment_count, day AS created_date
           FROM video_daily WINDOW w AS (PARTITION BY video_id ORDER BY day)""",
    ),
    "channel_daily": (
        [],
        """SELECT 'UC' || lpad((user_id // 8)::VARCHAR, 22, '0') AS channel_id, ts::DATE AS day,
             count(*) FILTER (WHERE event_type = 'view') AS views,
             count(*) FILTER (WHERE event_type = 'signup') AS signups,
             count(*) FILTER (WHERE event_type = 'purchase') AS purchases
           FROM events GROUP BY ALL""",
    ),
    "channel_log": (
        ["channel_daily"],
        """SELECT channel_id, (sum(views) OVER w)::BIGINT AS view_count,
             (sum(signups) OVER w)::BIGINT AS sub_count,
             (sum(purchases) OVER w)::BIGINT AS video_count, day AS created_date
           FROM channel_daily WINDOW w AS (PARTITION BY channel_id ORDER BY day)""",
    ),
    "video": (
        [],
        """SELECT 'v' || lpad(c_custkey::VARCHAR, 10, '0') AS video_id,
             'UC' || lpad((c_custkey // 8)::VARCHAR, 22, '0') AS channel_id,
             c_name AS title,
             CASE WHEN c_custkey % 3 = 0 THEN 'short' ELSE 'video' END AS video_type,
             DATE '2024-01-25' - ((7 * c_custkey) % 60)::INTEGER AS published_date,
             (DATE '2024-01-25' - ((7 * c_custkey) % 60)::INTEGER)::TIMESTAMP
               + to_hours(c_custkey % 24) AS published_time,
             (97 * c_custkey) % 5400 + 30 AS seconds,
             format('{:02d}:{:02d}:{:02d}', ((97 * c_custkey) % 5400 + 30) // 3600,
               (((97 * c_custkey) % 5400 + 30) // 60) % 60,
               ((97 * c_custkey) % 5400 + 30) % 60) AS duration,
             'https://img.example.net/v' || lpad(c_custkey::VARCHAR, 10, '0') AS thumbnail_url,
             c_mktsegment AS tags, c_nationkey AS categoryid,
             c_custkey % 5 <> 0 AS active, c_custkey
           FROM customer""",
    ),
    "channel": (
        [],
        """SELECT 'UC' || lpad(c_custkey::VARCHAR, 22, '0') AS channel_id, c_name AS name,
             '@' || lower(c_name) AS customurl,
             (DATE '2024-01-25' - ((7 * c_custkey) % 60)::INTEGER)::TIMESTAMP AS published_date,
             CASE WHEN c_nationkey > 0 THEN lpad(c_nationkey::VARCHAR, 2, '0') END AS country,
             p_brand AS keywords,
             CASE WHEN p_size > 2 THEN replace(p_name, ' ', ', ') END AS topic,
             c_acctbal >= 0 AS active
           FROM customer LEFT JOIN part ON p_partkey = c_custkey""",
    ),
    "last_channel": (
        ["channel_log"],
        """SELECT * FROM channel_log
           QUALIFY row_number() OVER (PARTITION BY channel_id ORDER BY created_date DESC) = 1""",
    ),
    "last_video": (
        ["video_log"],
        """SELECT * FROM video_log
           QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY created_date DESC) = 1""",
    ),
}


def with_views(names: list[str], select: str, **more: str) -> str:
    """SQL with the named views, and further ones given as text, in front."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        needs, body = VIEWS[name]
        for need in needs:
            add(need)
        parts.setdefault(name, body)

    for name in names:
        add(name)
    parts |= more
    heads = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {heads}\n{select}" if heads else select


def printed(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, which compare alike everywhere."""
    columns = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DateType):
            columns[field.name] = F.col(f"`{field.name}`").cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns[field.name] = F.date_format(f"`{field.name}`", "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(columns)


def query(
    sql: str | None = None, nullable: tuple[str, ...] = ()
) -> Callable[[Query], Query]:
    """Register a function under its own name.

    Whole-number columns named in ``nullable`` hold nulls and are compared as
    doubles, since data frames on the two sides hold such columns differently.
    """

    def register(function: Query) -> Query:
        name = function.__name__
        assert name not in QUERIES, name

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = printed(function(tune(spark), folder))
            return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in nullable})

        QUERIES[name] = run
        if sql is not None:
            doubles = ", ".join(f'"{c}"::DOUBLE AS "{c}"' for c in nullable)
            SQL[name] = f"SELECT * REPLACE ({doubles}) FROM (\n{sql})" if nullable else sql
        return function

    return register
