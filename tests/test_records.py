import csv
import random

import pytest
from pyspark.sql import functions as F

from viewtide.sources import readers, records, writers


@pytest.fixture
def small_blocks(spark):
    """Files are cut every few hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator=end).writerows(rows)


BITS = ["a", ",", '"', "\n", "\n\n", "\r\n", " ", "é", '""', "x" * 50]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_one_file_in_many_tasks(spark, small_blocks, tmp_path, end, broadcast):
    draw = random.Random(1)
    rows = [(str(i), "".join(draw.choice(BITS) for _ in range(draw.randrange(1, 12)))) for i in range(400)]
    rows += [("400", "long\n" * 500), ("401", "b")]
    write(f"{tmp_path}/f.csv", [("id", "t"), *rows], end)
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert spark.read.text(f"{tmp_path}/f.csv").rdd.getNumPartitions() > 20
        found = records.read_csv_records(spark, f"{tmp_path}/f.csv", "id long, t string").collect()
        assert sorted((str(r.id), r.t) for r in found) == sorted(rows)
        text = records.read_csv_records(spark, f"{tmp_path}/f.csv")
        assert text.columns == ["id", "t"] and sorted(map(tuple, text.collect())) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_not_shuffled(spark, tmp_path):
    write(f"{tmp_path}/f.csv", [("id", "t"), ("1", "a\nb")])
    plan = records.csv_records(spark, f"{tmp_path}/f.csv")._jdf.queryExecution().executedPlan().toString()
    # The one exchange puts pieces of records together, which come from a table of their own.
    assert plan.index("Exchange hashpartitioning(file") > plan.index("Union") and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_several_files_and_odd_ends(spark, small_blocks, rows, tmp_path):
    write(f"{tmp_path}/a.csv", [("id", "t"), ("1", "x\ny"), ("2", "")])
    write(f"{tmp_path}/b.csv", [("id", "t")])
    (tmp_path / "c.csv").write_text('id,t\n3,z\n\n4,"not closed\nat all')
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text('id,t\n5,"""q"""')
    found = rows(records.read_csv_records(spark, str(tmp_path), "id int, t string"))
    assert found[:3] == [(1, "x\ny"), (2, None), (3, "z")] and found[4] == (5, '"q"')
    assert found[3][0] == 4 and "not closed" in found[3][1]


def test_header_must_match(spark, tmp_path):
    write(f"{tmp_path}/f.csv", [("t", "id"), ("1", "2")])
    with pytest.raises(Exception, match="the header should be"):
        records.read_csv_records(spark, f"{tmp_path}/f.csv", "id int, t string").collect()


def test_rejected_rows_are_kept(spark, rows, tmp_path):
    (tmp_path / "f.csv").write_text('id,day\n1,2024-01-01\nx,2024-01-02\n3,"not\na day"\n4\n5,2024-01-05,more\nid,day\n')
    shape = "id int, day date"
    df = records.read_csv_records(spark, f"{tmp_path}/f.csv", shape, rejected="_bad")
    good, bad = records.sorted_out(df, "_bad")
    assert rows(good.select("id", F.col("day").cast("string"))) == [(1, "2024-01-01")]
    assert rows(bad) == [('3,"not\na day"',), ("4",), ("5,2024-01-05,more",), ("id,day",), ("x,2024-01-02",)]
    with pytest.raises(Exception):
        records.read_csv_records(spark, f"{tmp_path}/f.csv", shape).collect()


def test_written_and_read(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'a, "b"\nc', None), (2, " p ", "\r\n"), (3, None, ""), (4, "back\\slash", "周")], "id int, t string, u string")
    writers.write_csv(df, f"{tmp_path}/csv")
    found = rows(readers.read_csv(spark, f"{tmp_path}/csv", df.schema, multi_line=True))
    # As Spark reads files that it does not split: an empty text is null.
    assert found == rows(spark.read.options(**readers.CSV, multiLine=True).schema(df.schema).csv(f"{tmp_path}/csv"))
    assert found == rows(df.replace("", None, "u"))


def test_nothing(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id\n")
    assert records.read_csv_records(spark, str(tmp_path), "id int").collect() == []
