"""Topics, labels, id lists, and values picked out of page text."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Patterns of the stored page texts.
LISTING_ID = r'Endpoint":\{"videoId":"(.*?)",'
NEXT_PAGE_ID = r'"videoRenderer":\{"videoId":"(.*?)",'
NEXT_TOKEN = r'"continuationCommand":\{"token":"(.*?)",'
API_KEY = r'"INNERTUBE_API_KEY":"(.*?)",'
SEARCH_HIT = r'"channelId":"(.*?)","title":\{"simpleText":"(.*?)"\}'
TAB = r'\{"tabRenderer":(.*?\}\}.*?\}\}.*?\})\}'

OTHER = "Other"


def id_tokens(text: Column) -> Column:
    """Comma-separated entries with all blanks removed."""
    return F.split(F.replace(text, F.lit(" "), F.lit("")), ",")


def last_segments(urls: Column) -> Column:
    """Last path segment of each URL, joined by ``', '``."""
    names = F.transform(urls, lambda url: F.element_at(F.split(url, "/"), -1))
    return F.when(urls.isNotNull(), F.array_join(names, ", "))


def topic_label(token: Column) -> Column:
    """Short label of a topic: one spelling for lifestyle, one for all kinds of music."""
    return (
        F.when(token == "Lifestyle_(sociology)", "Lifestyle")
        .when(token.contains("Music"), "Music")
        .otherwise(token)
    )


def topic_category(topic: Column, labels: Column) -> Column:
    """First entry of ``labels`` that occurs in ``topic``, else ``Other``."""
    hits = F.filter(labels, lambda label: F.contains(topic, label))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(OTHER))


def register(spark: SparkSession) -> None:
    """Make ``topic_category(topic, labels)`` callable from SQL text."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION topic_category(topic STRING, labels ARRAY<STRING>)"
        " RETURNS STRING RETURN"
        f" coalesce(get(filter(labels, label -> contains(topic, label)), 0), '{OTHER}')"
    )


def squeeze(text: Column) -> Column:
    """Text without blanks and line feeds."""
    return F.translate(text, " \n", "")


def find_all(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of one group, in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def find_first(text: Column, pattern: str, missing: str | None = None) -> Column:
    """First match of the first group, ``missing`` if there is none. The search ends with it."""
    found = F.regexp_extract(text, pattern, 1)
    if missing != "":
        # An empty match differs from none only here.
        found = F.when(F.regexp_like(text, F.lit(pattern)), found)
    return found if missing is None else F.coalesce(found, F.lit(missing))


def find_pairs(text: Column, pattern: str, first: str, second: str) -> Column:
    """All matches of a two-group pattern, as an array of structs; the text is read once."""
    return F.transform(
        find_all(text, pattern, 0),
        lambda hit: F.struct(
            F.regexp_extract(hit, pattern, 1).alias(first),
            F.regexp_extract(hit, pattern, 2).alias(second),
        ),
    )


def tab_titles(text: Column) -> Column:
    """Titles of the tabs of a channel page. The first tab is always ``Home``."""
    tabs = find_all(text, TAB)
    rest = F.transform(
        F.slice(tabs, 2, F.greatest(F.size(tabs), F.lit(1))),
        lambda tab: F.get_json_object(tab, "$.title"),
    )
    return F.concat(F.array(F.lit("Home")), F.filter(rest, lambda title: title.isNotNull()))
