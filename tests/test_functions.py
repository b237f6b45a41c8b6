import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from viewtide.functions import dates, durations, payload, ratios, text
from viewtide.plans import ingest, pages

D = dt.date
# Three quarters past noon in Taipei.
NOON = "2023-11-30T04:45:10Z"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_calendar_parts(spark):
    parts = dates.calendar_parts(F.lit(D(2024, 12, 30)))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    # A Monday that belongs to ISO week 1 of the next year.
    assert tuple(row) == (2024, 12, 30, 1, 2, 4, 365, False)


@pytest.mark.parametrize("day, weekend", [(5, False), (6, True), (7, True), (8, False)])
def test_weekend(spark, day, weekend):
    assert value(spark, dates.calendar_parts(F.lit(D(2024, 4, day)))["is_weekend"]) is weekend


def test_month_bounds_agree(spark):
    for as_of in (D(2024, 3, 31), D(2024, 1, 1), D(2023, 3, 5)):
        first, last = dates.month_before(as_of)
        assert value(spark, dates.previous_month_start(F.lit(as_of))) == first
        assert value(spark, dates.previous_month_end(F.lit(as_of))) == last
        assert value(spark, dates.month_checkpoints(F.lit(first))) == dates.checkpoint_days(first)
    assert dates.month_before(D(2024, 3, 31)) == (D(2024, 2, 1), D(2024, 2, 29))


def test_local_time(spark):
    local = dates.local_timestamp(F.lit(NOON), "Asia/Taipei")
    assert value(spark, dates.clock_time(local)) == "12:45:10"
    assert value(spark, F.to_date(local)) == D(2023, 11, 30)
    late = dates.local_timestamp(F.lit("2023-11-30T16:30:00Z"), "Asia/Taipei")
    assert value(spark, F.to_date(late)) == D(2023, 12, 1)


def test_local_time_in_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = dates.local_timestamp(F.lit(NOON), "Asia/Taipei")
        assert value(spark, local) == dt.datetime(2023, 11, 30, 12, 45, 10)
        assert value(spark, dates.local_timestamp(F.lit("soon"), "Asia/Taipei")) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_dates_are_null(spark):
    assert value(spark, dates.parse_date(F.lit("soon"))) is None
    assert value(spark, dates.parse_date(F.lit("2023-11-30"))) == D(2023, 11, 30)


def test_epoch(spark):
    assert value(spark, dates.epoch_to_date(F.lit(1711929600))) == D(2024, 4, 1)


@pytest.mark.parametrize(
    "stored, seconds",
    [
        ("PT7M42S", 462),
        ("PT1H6M40S", 4000),
        ("PT45S", 45),
        ("PT0S", 0),
        ("P1DT2H", 93600),
        ("P2W", 1209600),
        ("PT1.9S", 1),
        ("P0D", 0),
        ("P", None),
        ("PT", None),
        ("P1M", None),
        ("11:06", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_seconds(spark, stored, seconds):
    assert value(spark, durations.iso_seconds(F.lit(stored).cast("string"))) == seconds


def test_iso_interval(spark):
    assert value(spark, durations.iso_interval(F.lit("PT7M42S"))) == dt.timedelta(seconds=462)


@pytest.mark.parametrize(
    "clock, parts",
    [
        ("01:06:40", (1, 6, 40)),
        ("11:06", (11, 6, None)),
        ("1 day 02:03:04", (26, 3, 4)),
        ("3 days 00:00:01", (72, 0, 1)),
        ("soon", (None, None, None)),
        ("x day 02:03:04", (None, 3, 4)),
        (None, (None, None, None)),
    ],
)
def test_clock_parts(spark, clock, parts):
    found = durations.clock_parts(F.lit(clock).cast("string"))
    assert tuple(value(spark, c) for c in found.values()) == parts


def test_clock_lengths(spark):
    assert value(spark, durations.clock_minutes(F.lit("01:00:30"))) == 60.5
    assert value(spark, durations.clock_minutes(F.lit("11:06"))) is None
    assert value(spark, durations.whole_minutes_up(F.lit(61))) == 2
    assert value(spark, durations.whole_minutes_up(F.lit(60))) == 1
    assert value(spark, durations.clock_text(F.lit(4000))) == "01:06:40"
    assert value(spark, durations.clock_text(F.lit(93600))) == "26:00:00"
    assert value(spark, durations.clock_text(F.lit(None).cast("long"))) is None


def test_quotients(spark):
    assert value(spark, ratios.int_ratio(F.lit(19), F.lit(10))) == 1
    assert value(spark, ratios.int_ratio(F.lit(-19), F.lit(10))) == -1
    assert value(spark, ratios.int_ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, ratios.ratio(F.lit(1), F.lit(4))) == 0.25


def test_tokens_and_labels(spark):
    assert value(spark, text.id_tokens(F.lit("first, second"))) == [
        "first",
        "second",
    ]
    urls = F.array(F.lit("https://x.org/wiki/Technology"), F.lit("https://x.org/wiki/Pop_Music"))
    assert value(spark, text.last_segments(urls)) == "Technology, Pop_Music"
    for token, label in [
        ("Lifestyle_(sociology)", "Lifestyle"),
        ("Hip_hop_Music", "Music"),
        ("Knowledge", "Knowledge"),
    ]:
        assert value(spark, text.topic_label(F.lit(token))) == label


def test_topic_category(spark):
    labels = F.array(F.lit("Music"), F.lit("Lifestyle"))
    assert value(spark, text.topic_category(F.lit("Lifestyle_(sociology), Music"), labels)) == "Music"
    assert value(spark, text.topic_category(F.lit("lifestyle"), labels)) == "Other"
    assert value(spark, text.topic_category(F.lit(None).cast("string"), labels)) == "Other"
    text.register(spark)
    query = "SELECT topic_category('A, Lifestyle', array('Music', 'Lifestyle')) AS v"
    assert spark.sql(query).first().v == "Lifestyle"


def tab(title):
    """A tab of a channel page: what stands between its name and its title has two levels of braces."""
    inner = json.dumps({"endpoint": {"a": {"b": {}}, "c": {}}})[1:-1].replace(" ", "")
    return f'{{"tabRenderer":{{{inner},"title":"{title}"}}}}'


def hit(channel, name):
    """A hit of a search page."""
    return f'"channelId":"{channel}","title":{{"simpleText":"{name}"}}'


def ids(*numbers, first=False, more=False):
    """A listing page: its videos, written one way on the first page and another on later ones, and a token if there is more."""
    before = '"Endpoint":{"videoId":' if first else '"videoRenderer": {"videoId": '
    lines = [f'{before}"clip-{n}",' for n in numbers]
    if more:
        lines.append('"continuationCommand":{"token":"t",')
    return "".join(line + "\n" for line in lines)


def clips(count):
    return [f"clip-{n}" for n in range(count)]


def test_channel_page(spark):
    # The first tab is Home in whatever language its title is.
    body = "\n".join([tab("Inicio"), tab("Live"), tab("Clips"), '"INNERTUBE_API_KEY":"k 77",'])
    page = spark.createDataFrame([("c", body), ("d", "no page at all")], "id string, body string")
    tabs = pages.channel_tabs(page, ["id"]).orderBy("id", "pos").collect()
    assert [(r.id, r.tab) for r in tabs] == [("c", "Home"), ("c", "Live"), ("c", "Clips"), ("d", "Home")]
    keys = {r.id: r.api_key for r in pages.api_key(page, ["id"]).collect()}
    assert keys == {"c": "k 77", "d": None}


def test_search_page(spark, rows):
    pairs = [("A1", "first hit"), ("B2", "hit"), ("A1", "again")]
    page = spark.createDataFrame([(" ".join(hit(*p) for p in pairs),)], "body string")
    assert rows(pages.search_hits(page, [])) == [(n, *p) for n, p in enumerate(pairs)]


def listing(spark, bodies, limit):
    data = [("c", "video", n, body) for n, body in enumerate(bodies)]
    stored = spark.createDataFrame(data, "channel_id string, video_type string, page_no int, body string")
    found = pages.listing(stored, limit).orderBy("page_no", "pos").collect()
    return [r.video_id for r in found]


def test_listing_is_capped(spark):
    bodies = [ids(0, 1, 2, first=True, more=True), ids(3, more=True), ids(4, 5, more=True)]
    for limit in range(1, 7):
        assert listing(spark, bodies, limit) == clips(limit)


def test_listing_ends(spark):
    assert listing(spark, [""], 20) == []
    # Page 0 has no token, a later page has none, a later page has no ids.
    assert listing(spark, [ids(0, first=True), ids(1)], 20) == clips(1)
    assert listing(spark, [ids(0, first=True, more=True), ids(1, 2), ids(3)], 20) == clips(3)
    assert listing(spark, [ids(0, 1, first=True, more=True), ids(more=True), ids(2)], 20) == clips(2)


def item(**fields):
    """A document with one item; a field's name is its path, joined by double underscores."""
    found = {}
    for path, held in fields.items():
        *outer, last = path.split("__")
        place = found
        for name in outer:
            place = place.setdefault(name, {})
        place[last] = held
    return {"items": [found]}


FULL = item(
    id="chan-1",
    snippet__title="Bees",
    snippet__customUrl="@bees",
    snippet__publishedAt="2019-09-08T01:02:03Z",
    snippet__thumbnails__high__url="big.png",
    snippet__country="PE",
    statistics__viewCount="31",
    statistics__subscriberCount="4",
    statistics__videoCount="2",
    topicDetails__topicCategories=["http://x/Honey", "http://x/Hive_(box)"],
    brandingSettings__channel__description="about bees",
    brandingSettings__channel__keywords="wax 'queen bee'",
    brandingSettings__channel__country="PE",
)
BARE = item(
    id="chan-2",
    snippet__title="-",
    snippet__publishedAt="",
    snippet__thumbnails__high__url="s.png",
    brandingSettings__channel__description="",
)


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "body string")


def test_channel_info(spark, rows):
    found = rows(payload.channel_info(documents(spark, FULL, BARE, {}, {"items": []})))
    about = ("chan-1", "Bees", "@bees", "2019-09-08T01:02:03Z", "big.png", "about bees", "PE", "wax 'queen bee'")
    assert found == [(*about, "Honey, Hive_(box)"), ("chan-2", "-", None, "", "s.png", "", None, None, None)]


def test_rejected_documents(spark, rows):
    """Documents without items are valid; those cut short and nulls are not."""
    full = json.dumps(FULL)
    bodies = [full, full[:-1], "{}", '{"items": []}', "", None, "no json"]
    docs = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    assert [r.n for r in payload.rejected(docs).orderBy("n").collect()] == [1, 4, 5, 6]
    assert payload.channel_info(docs).count() == 1


def test_channel_counters(spark, rows):
    counters = payload.channel_counters(documents(spark, FULL, {}))
    assert rows(counters) == [("chan-1", "31", "4", "2")]
    snapshot = ingest.channel_snapshot(documents(spark, FULL), D(2022, 8, 9))
    assert rows(snapshot) == [("chan-1", 31, 4, 2, D(2022, 8, 9))]


def video_document(video_id="new", **statistics):
    return item(
        id=video_id,
        snippet__publishedAt=NOON,
        snippet__title="Waggle dance",
        snippet__description="line one\nline two",
        snippet__thumbnails__high__url="v.png",
        snippet__tags=["x", "y z"],
        snippet__categoryId="15",
        contentDetails__duration="PT7M42S",
        statistics=statistics,
    )


def test_video_counters_may_be_hidden(spark, rows):
    docs = spark.createDataFrame(
        [("v1", json.dumps(video_document("v1", viewCount="7"))), ("v2", json.dumps({"items": []})),
         ("v3", json.dumps(video_document("v3", viewCount="9", likeCount="1", commentCount="2")))],
        "video_id string, body string",
    )
    video = spark.createDataFrame([("v1", True), ("v2", True), ("v3", False)], "video_id string, active boolean")
    found = ingest.video_snapshot(video, docs, D(2023, 11, 30))
    assert rows(found) == [("v1", 7, None, None, D(2023, 11, 30))]


def test_new_videos(spark, rows):
    columns = "channel_id string, video_type string, page_no int, pos int, video_id string"
    listed = spark.createDataFrame(
        [("c", "video", 0, 0, "new"), ("c", "video", 0, 1, "new"),
         ("c", "video", 0, 2, "old"), ("c", "short", 0, 0, "old"), ("c", "clip", 0, 0, "gone")],
        columns,
    )
    stored = spark.createDataFrame([("c", "video", "old")], "channel_id string, video_type string, video_id string")
    body = json.dumps(video_document())
    docs = spark.createDataFrame(
        [("new", body), ("new", body), ("old", json.dumps(video_document("old")))],
        "video_id string, body string",
    )
    found = ingest.new_videos(listed, stored, docs)
    wanted = ["channel_id", "video_type", "video_id", "published_date", "published_time", "duration"]
    taipei = dt.datetime(2023, 11, 30, 12, 45, 10)
    # The same id is new as another type; an unknown type or a missing document is no error.
    assert rows(found, *wanted) == [
        ("c", "short", "old", D(2023, 11, 30), taipei, "00:07:42"),
        ("c", "video", "new", D(2023, 11, 30), taipei, "00:07:42"),
    ]
    assert rows(found, "tags", "categoryid")[0] == ("x, y z", 15)


def test_registered_channels(spark, rows):
    docs = documents(spark, FULL).withColumn("channel_id", F.lit("chan-1"))
    listed = spark.createDataFrame([("chan-1",), ("unknown",), ("chan-1",)], "channel_id string")
    assert rows(ingest.registered_channels(listed, docs), "name") == [("Bees",)]
    assert rows(ingest.registered_channels(listed.where("channel_id = 'unknown'"), docs)) == []
