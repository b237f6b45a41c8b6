import datetime as dt
import json

import pytest
from pyspark.sql import Observation, functions as F

from viewtide import schema, session
from viewtide.operators.quality import report
from viewtide.plans.extract import extract
from viewtide.plans.ingest import expire_videos
from viewtide.sources import readers, writers
from viewtide.streaming import snapshots

D = dt.date
AWKWARD = [(1, 'a, "b"\nc'), (2, " padded "), (3, None), (4, "back\\slash"), (5, "周, 杰")]


def test_csv_keeps_awkward_text(spark, rows, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id int, t string")
    writers.write_csv(df, f"{tmp_path}/csv")
    assert rows(readers.read_csv(spark, f"{tmp_path}/csv", "id int, t string", multi_line=True)) == AWKWARD
    assert rows(readers.read_csv(spark, f"{tmp_path}/csv", multi_line=True), "id")[0] == ("1",)
    inferred = readers.read_csv_inferred(spark, f"{tmp_path}/csv", multi_line=True)
    assert dict(inferred.dtypes) == {"id": "int", "t": "string"}


def test_csv_file_is_split(spark, tmp_path):
    spark.range(20000).coalesce(1).write.csv(f"{tmp_path}/csv", header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        for read in (readers.read_csv, readers.read_csv_inferred):
            assert read(spark, f"{tmp_path}/csv").rdd.getNumPartitions() > 2
        assert readers.read_csv(spark, f"{tmp_path}/csv", multi_line=True).rdd.getNumPartitions() > 2
        assert readers.read_csv(spark, f"{tmp_path}/csv", multi_line=True).count() == 20000
        for read in (readers.read_csv, readers.read_csv_inferred):
            assert read(spark, f"{tmp_path}/csv").count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_header_must_match(spark, tmp_path):
    spark.createDataFrame(AWKWARD, "id int, t string").coalesce(1).write.csv(f"{tmp_path}/csv", header=True)
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, f"{tmp_path}/csv", "t string, id int").collect()


def test_export_and_partitions(spark, rows, tmp_path):
    df = spark.createDataFrame([("c1", 1), ("c2", 2), ("c2", 3)], "channel_id string, n int")
    writers.export_csv(spark, "SELECT n FROM {df} WHERE n > 1", f"{tmp_path}/out", df=df)
    assert rows(readers.read_csv(spark, f"{tmp_path}/out", "n int")) == [(2,), (3,)]
    writers.write_csv(df, f"{tmp_path}/by_channel", partition_by="channel_id")
    assert sorted(p.name for p in (tmp_path / "by_channel").glob("channel_id=*")) == [
        "channel_id=c1",
        "channel_id=c2",
    ]
    writers.write_table(df, f"{tmp_path}/table", partition_by="channel_id")
    writers.write_table(df, f"{tmp_path}/table", partition_by="channel_id")
    assert readers.read_parquet(spark, f"{tmp_path}/table").count() == 3


@pytest.mark.parametrize("csv, buckets", [(False, 64), (True, 64), (False, 7)])
def test_layout_by_key(spark, rows, tmp_path, csv, buckets):
    df = spark.range(3000).selectExpr("concat('c', if(id % 3 = 0, 0, id % 500)) AS channel_id", "id AS n")
    writers.write_by_key(df, f"{tmp_path}/t", "channel_id", csv, buckets)
    folders = len(list((tmp_path / "t").glob("key_bucket=*")))
    assert 1 < folders <= buckets
    shape = "channel_id string, n long"
    stored = spark.read.parquet(f"{tmp_path}/t") if not csv else readers.read_csv(spark, f"{tmp_path}/t", shape)
    assert stored.count() == 3000
    one = readers.rows_of_key(stored, "channel_id", "c7")
    assert rows(one, "channel_id", "n") == rows(df.where("channel_id = 'c7'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan


def test_append_counts_and_fills(spark, rows, tmp_path):
    log = spark.createDataFrame([(5, "v1")], "view_count int, video_id string")
    path = f"{tmp_path}/log"
    assert writers.append(log, path, schema.VIDEO_LOG, schema.LOG_DEFAULTS) == 1
    more = spark.createDataFrame([("v2", None), ("v3", 7)], "video_id string, like_count int")
    stamped = {**schema.LOG_DEFAULTS, "created_at": F.current_timestamp()}
    assert writers.append(more, path, schema.VIDEO_LOG, stamped) == 2
    stored = spark.read.schema(schema.VIDEO_LOG).parquet(path)
    assert rows(stored, "video_id", "view_count", "like_count", "comment_count") == [
        ("v1", 5, 0, 0), ("v2", 0, None, 0), ("v3", 0, 7, 0),
    ]
    assert stored.where("created_at is null").count() == 1


def test_nothing_to_append(spark, tmp_path):
    empty = spark.createDataFrame([], schema.VIDEO_LOG)
    assert writers.append(empty, f"{tmp_path}/log", schema.VIDEO_LOG) == 0
    assert writers.append(empty.where("1 = 0"), f"{tmp_path}/log", schema.VIDEO_LOG) == 0


def test_update_reports_its_count(spark):
    video = spark.createDataFrame(
        [("a", D(2023, 1, 1), True), ("b", D(2024, 2, 9), True), ("c", D(2023, 1, 1), False)],
        "video_id string, published_date date, active boolean",
    )
    counted = Observation()
    expire_videos(video, D(2024, 2, 10), counted=counted).write.format("noop").mode("overwrite").save()
    assert writers.observed_rows(counted) == 1


@pytest.fixture
def stored_video(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "video_id string, n int")
    rows.write.parquet(f"{tmp_path}/first")
    spark.catalog.createTable("stored_video", f"{tmp_path}/first", "parquet")
    yield "stored_video"
    spark.sql("DROP TABLE stored_video")


def test_update_is_stored(spark, rows, tmp_path, stored_video):
    def change(table, counted):
        return writers.updated(table, F.col("n") > 1, {"n": F.lit(0)}, counted)

    changed = [writers.update_table(spark, stored_video, str(tmp_path), change) for _ in range(2)]
    assert changed == [1, 0]
    assert rows(spark.table(stored_video)) == [("a", 1), ("b", 0), ("c", None)]


def test_failed_update_leaves_the_table(spark, rows, tmp_path, stored_video):
    def change(table, counted):
        return writers.updated(table, F.col("n") > 1, {"n": F.raise_error(F.lit("lost")).cast("int")}, counted)

    with pytest.raises(Exception, match="lost"):
        writers.update_table(spark, stored_video, str(tmp_path), change)
    assert rows(spark.table(stored_video)) == [("a", 1), ("b", 2), ("c", None)]


def test_id_list(spark, rows, tmp_path):
    (tmp_path / "ids.txt").write_text("first, second,\n id 3,,first\n")
    found = readers.read_id_list(spark, f"{tmp_path}/ids.txt")
    assert rows(found) == [("first",), ("first",), ("id3",), ("second",)]


def test_documents(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"items": []}, indent=1))
    found = readers.read_documents(spark, f"{tmp_path}/*.json").collect()
    assert [json.loads(r.body) for r in found] == [{"items": []}] * 2


def test_jdbc_reads_are_split(spark, monkeypatch):
    assert readers.day_predicates("created_date", D(2024, 2, 28), D(2024, 3, 1)) == [
        "created_date = DATE '2024-02-28'",
        "created_date = DATE '2024-02-29'",
        "created_date = DATE '2024-03-01'",
    ]
    calls = []
    monkeypatch.setattr(
        type(spark.read), "jdbc", lambda self, url, table, **options: calls.append((table, options))
    )
    readers.read_jdbc(spark, "jdbc:x", "video", "categoryid", "0", "50", 8)
    readers.read_jdbc_days(spark, "jdbc:x", "video_log", "created_date", D(2024, 1, 1), D(2024, 1, 2))
    assert calls[0] == (
        "video",
        {"column": "categoryid", "lowerBound": "0", "upperBound": "50", "numPartitions": 8, "properties": {}},
    )
    assert len(calls[1][1]["predicates"]) == 2


def test_jdbc_appends_in_batches(spark, monkeypatch):
    calls = []
    df = spark.range(1)
    writer = type(df.write)
    monkeypatch.setattr(writer, "jdbc", lambda self, url, table, **options: calls.append((url, table, options)))
    writers.append_jdbc(df, "jdbc:x", "video_log", {"user": "me"}, batch=500)
    assert calls == [("jdbc:x", "video_log", {"mode": "append", "properties": {"batchsize": "500", "user": "me"}})]


def test_sql_over_named_tables(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    assert rows(readers.run_sql(spark, "SELECT t FROM {numbers} WHERE n > 1", numbers=df)) == [("b",)]


def test_extract_twice(spark, rows, tmp_path):
    log = spark.createDataFrame(
        [("v", D(2024, 1, 1), 1), ("v", D(2024, 1, 2), 2)], "video_id string, created_date date, view_count long"
    )
    for _ in range(2):
        paths = extract({"video_log": log}, str(tmp_path))
    stored = readers.read_parquet(spark, paths["video_log"])
    assert rows(stored, "video_id", "created_date", "view_count") == rows(log)
    plan = stored.where(F.col("created_date") == D(2024, 1, 2))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda name, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_constraints_name_canonical_columns():
    for table, rules in schema.CONSTRAINTS.items():
        names = schema.TABLES[table].fieldNames()
        listed = rules.get("primary", []) + rules.get("unique", []) + rules.get("required", [])
        for kind in ("exact", "longest", "allowed", "refers"):
            listed += list(rules.get(kind, {}))
        assert set(listed) <= set(names)


def test_empty_tables_have_no_violations(spark):
    tables = {name: spark.createDataFrame([], shape) for name, shape in schema.TABLES.items()}
    assert report(tables).count() == 0


SNAPSHOT = "video_id string, created_date date, view_count long, created_at timestamp"


def snapshot_files(spark, folder, batches):
    for number, batch in enumerate(batches):
        data = [(v, D(2024, 1, day), count, dt.datetime(2024, 1, day, hour)) for v, day, count, hour in batch]
        spark.createDataFrame(data, SNAPSHOT).coalesce(1).write.json(f"{folder}/in", mode="append")
        yield number


BATCHES = [
    [("a", 1, 10, 9), ("b", 1, 20, 9), ("a", 1, 10, 9)],
    [("a", 2, 11, 9), ("a", 1, 10, 9)],  # one repeat of an earlier batch
    [("b", 2, 21, 9), ("c", 1, 30, 9)],  # one late first report
]
LOG = [("a", D(2024, 1, 1), 10), ("a", D(2024, 1, 2), 11), ("b", D(2024, 1, 1), 20),
       ("b", D(2024, 1, 2), 21), ("c", D(2024, 1, 1), 30)]


@pytest.mark.parametrize("one_by_one", [True, False])
def test_stream_ingest(spark, rows, tmp_path, one_by_one):
    def run():
        stream = spark.readStream.schema(SNAPSHOT).json(f"{tmp_path}/in")
        snapshots.ingest(stream, f"{tmp_path}/log", f"{tmp_path}/progress", "video_id").awaitTermination()

    for _ in snapshot_files(spark, tmp_path, BATCHES):
        if one_by_one:
            run()
    run()
    stored = spark.read.schema(SNAPSHOT).parquet(f"{tmp_path}/log")
    assert rows(stored, "video_id", "created_date", "view_count") == LOG


def test_repeated_batch_adds_nothing(spark, rows, tmp_path):
    data = [("a", D(2024, 1, 1), 1, None), ("a", D(2024, 1, 1), 2, dt.datetime(2024, 1, 1, 9))]
    batch = spark.createDataFrame(data, SNAPSHOT)
    added = [snapshots.append_new_days(batch, f"{tmp_path}/log", "video_id") for _ in range(2)]
    assert added == [1, 0]
    assert rows(spark.read.parquet(f"{tmp_path}/log"), "video_id", "view_count") == [("a", 2)]


def test_stream_without_repeats(spark, rows, tmp_path):
    for _ in snapshot_files(spark, tmp_path, BATCHES):
        stream = spark.readStream.schema(SNAPSHOT).json(f"{tmp_path}/in").drop("created_at")
        single = snapshots.without_repeats(stream, "video_id", "31 days")
        writer = single.writeStream.option("checkpointLocation", f"{tmp_path}/progress")
        writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "video_id", "created_date", "view_count") == LOG
