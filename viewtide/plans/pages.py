"""What stored page texts say: search hits, channel tabs and video listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.functions import text
from viewtide.operators.dedup import first_per_key
from viewtide.operators.joins import join_null_safe
from viewtide.operators.topk import cap_listing
from viewtide.session import settled


def search_hits(pages: DataFrame, keep: list[str], body: str = "body", pattern: str = text.SEARCH_HIT):
    """(channel_id, name) pairs of search pages, with their place on the page."""
    pairs = text.find_pairs(F.col(body), pattern, "channel_id", "name")
    hits = pages.select(*keep, F.posexplode(pairs).alias("pos", "hit"))
    return hits.select(*keep, "pos", "hit.channel_id", "hit.name")


def channel_tabs(pages: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """One row per tab of a channel page, ``Home`` first."""
    return pages.select(*keep, F.posexplode(text.tab_titles(F.col(body))).alias("pos", "tab"))


def api_key(pages: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """The key each channel page carries."""
    return pages.select(*keep, text.find_first(F.col(body), text.API_KEY).alias("api_key"))


def _page_ids(first_page: str, next_page: str, body: str) -> Column:
    """Ids of a listing page (``page_no`` 0) or of one of its continuations."""
    page = F.col(body)
    return F.when(F.col("page_no") == 0, text.find_all(page, first_page)).otherwise(
        text.find_all(text.squeeze(page), next_page)
    )


def page_token(body: str = "body") -> Column:
    """The continuation token of a page, empty on the last one."""
    page = F.col(body)
    searched = F.when(F.col("page_no") == 0, page).otherwise(text.squeeze(page))
    return text.find_first(searched, text.NEXT_TOKEN, "")


def listed_ids(
    pages: DataFrame,
    keep: list[str],
    body: str = "body",
    first_page: str = text.LISTING_ID,
    next_page: str = text.NEXT_PAGE_ID,
) -> DataFrame:
    """One row per video id of each page, in text order. ``pages`` has a ``page_no``."""
    ids = _page_ids(first_page, next_page, body)
    return pages.select(*keep, F.posexplode(ids).alias("pos", "video_id"))


def linked(
    pages: DataFrame,
    keys: tuple[str, ...] = ("channel_id", "video_type"),
    requested: str = "requested",
    body: str = "body",
) -> DataFrame:
    """Number the pages of each listing from 0 along their continuation tokens, as ``page_no``.

    ``requested`` is the token a page was asked for by, null or empty for the first page. A page's own token names the
    next one. A listing ends with a page without token, with a token no page was stored for, or where it comes back to
    a page it has been to. Pages that the first one does not lead to are left out; of pages stored twice one is taken.

    Places are found by doubling: when all pages up to place n are known, and from each page the one n places further,
    the next n places follow. So a listing of n pages takes log2(n) rounds, on tokens only.
    """
    asked = F.coalesce(F.col(requested), F.lit(""))
    first = F.when(asked == "", F.col(body)).otherwise(text.squeeze(F.col(body)))
    token = text.find_first(first, text.NEXT_TOKEN, "")
    boxed = pages.select(*keys, asked.alias("_asked"), token.alias("_next"), *[c for c in pages.columns if c not in keys])
    boxed = settled(first_per_key(boxed, [*keys, "_asked"], ["_next"]))
    steps = settled(boxed.where("_next <> ''").select(*keys, F.col("_asked").alias("_from"), F.col("_next").alias("_to")))
    found = settled(boxed.where("_asked = ''").select(*keys, "_asked", F.lit(0).alias("page_no")))
    length = 1
    while True:
        jumps = steps.withColumnsRenamed({"_from": "_asked"})
        further = join_null_safe(found, jumps, [*keys, "_asked"])
        further = further.select(*keys, F.col("_to").alias("_asked"), (F.col("page_no") + length).alias("page_no"))
        # A place that was reached before is nearer to the first page.
        every = found.unionByName(further).groupBy(*keys, "_asked").agg(F.min("page_no").alias("page_no"))
        known, found = found, settled(every)
        if found.count() == known.count():
            break
        ahead = steps.withColumnsRenamed({"_from": "_via", "_to": "_end"})
        steps = settled(join_null_safe(steps.withColumnRenamed("_to", "_via"), ahead, [*keys, "_via"]).select(*keys, "_from", F.col("_end").alias("_to")))
        length *= 2
    numbered = join_null_safe(boxed, found, [*keys, "_asked"])
    return numbered.select(*[c for c in pages.columns if c != "page_no"], "page_no")


def listing(
    pages: DataFrame, limit: int = 20, keys: tuple[str, ...] = ("channel_id", "video_type")
) -> DataFrame:
    """The newest ``limit`` ids per channel and type, across its pages in order.

    The list ends with the first page that has no continuation token, or the
    first continuation that has no ids.
    """
    ids = _page_ids(text.LISTING_ID, text.NEXT_PAGE_ID, "body")
    # Settled, so that the page texts are searched once.
    read = settled(pages.select(*keys, "page_no", ids.alias("ids"), page_token().alias("token")))
    ends = (F.col("token") == "") | ((F.col("page_no") > 0) & (F.size("ids") == 0))
    last = read.where(ends).groupBy(*keys).agg(F.min("page_no").alias("last"))
    kept = read.join(last, list(keys), "left").where("last is null or page_no <= last")
    rows = kept.select(*keys, "page_no", F.posexplode("ids").alias("pos", "video_id"))
    return cap_listing(rows, list(keys), ["page_no", "pos"], limit)
