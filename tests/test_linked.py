"""Listings whose pages are linked by continuation tokens only."""

import random

import pytest

from viewtide.functions import text
from viewtide.plans import pages

SCHEMA = "channel_id string, video_type string, requested string, body string"


def page(channel, asked, ids, token):
    entry = '"videoRenderer":{"videoId":"%s",' if asked else 'Endpoint":{"videoId":"%s",'
    body = " ".join(entry % i for i in ids)
    return channel, "video", asked, body + (f'"continuationCommand":{{"token":"{token}",' if token else "")


def followed(stored):
    """The pages one after the other, as a crawler would ask for them."""
    found = set()
    for channel in {s[0] for s in stored}:
        of = {s[2] or "": s for s in stored if s[0] == channel}
        asked, number, seen = "", 0, set()
        while asked in of and asked not in seen:
            seen.add(asked)
            found.add((channel, of[asked][2], number))
            body = of[asked][3]
            asked = body.split('"token":"')[1].split('"')[0] if '"token":"' in body else None
            number += 1
    return found


def check(spark, stored):
    df = spark.createDataFrame(stored, SCHEMA).repartition(3)
    numbered = pages.linked(df)
    assert numbered.columns == [*df.columns, "page_no"]
    found = [(r.channel_id, r.requested, r.page_no) for r in numbered.collect()]
    assert len(found) == len(set(found)) and set(found) == followed(stored)


def test_chains_of_any_length(spark):
    stored = []
    for channel, length in (("a", 1), ("b", 2), ("c", 7), ("d", 8), ("e", 150)):
        for i in range(length):
            stored.append(page(channel, f"t{i}" if i else None, [f"{channel}{i}"], f"t{i + 1}" if i < length - 1 else ""))
    random.Random(1).shuffle(stored)
    check(spark, stored)


def test_loops_gaps_and_strays(spark):
    stored = [
        page("loop", None, ["1"], "x"), page("loop", "x", ["2"], "y"), page("loop", "y", ["3"], "z"), page("loop", "z", ["4"], "x"),
        page("self", "", ["1"], "s"), page("self", "s", ["2"], "s"),
        page("gap", None, ["1"], "not stored"), page("gap", "other", ["2"], "more"), page("gap", "more", ["3"], "other"),
        page("no first", "x", ["1"], "y"), page("no first", "y", ["2"], ""),
    ]
    check(spark, stored)
    assert pages.linked(spark.createDataFrame(stored, SCHEMA).limit(0)).collect() == []


def test_pages_stored_twice_count_once(spark):
    stored = [page("a", None, ["1"], "x"), page("a", None, ["1"], "x"), page("a", "x", ["2"], ""), page("a", "x", ["2"], "")]
    found = pages.linked(spark.createDataFrame(stored, SCHEMA)).collect()
    assert sorted(r.page_no for r in found) == [0, 1]


@pytest.mark.parametrize("limit, expected", [(2, ["1", "2"]), (20, ["1", "2", "3", "4", "5"])])
def test_listing_in_page_order(spark, limit, expected):
    """A page without ids ends the listing, though it names a next one."""
    stored = [page("a", None, ["1", "2"], "z"), page("a", "z", ["3"], "b"), page("a", "b", ["4", "5"], "m"), page("a", "m", [], "k"), page("a", "k", ["6"], "")]
    found = pages.listing(pages.linked(spark.createDataFrame(stored[::-1], SCHEMA)), limit)
    assert [r.video_id for r in found.orderBy("page_no", "pos").collect()] == expected


def test_first_match(spark):
    df = spark.createDataFrame([('"INNERTUBE_API_KEY":"k1","INNERTUBE_API_KEY":"k2",',), ('"INNERTUBE_API_KEY":"",',), ("",), (None,)], "body string")
    for missing, expected in ((None, ["k1", "", None, None]), ("", ["k1", "", "", ""]), ("none", ["k1", "", "none", "none"])):
        found = df.select(text.find_first(df.body, text.API_KEY, missing).alias("k")).collect()
        assert [r.k for r in found] == expected
