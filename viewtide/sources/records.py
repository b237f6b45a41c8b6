"""CSV whose fields may hold line feeds, read by as many tasks as the file has blocks; and rows that do not parse, kept.

Spark splits a text file at line feeds, also at those inside quotes. Whether a line begins inside quotes follows from the number
of quotes before it in the file: it does if that is odd. So each block is first counted by itself, blocks before it in the
file say whether it begins inside quotes, and then each task puts the lines of its blocks together to records. A
record that goes on in another block leaves a piece on either side, at most two for each block, which are joined in the end.
Lines are not shuffled.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from viewtide.session import settled

QUOTE = '"'
# The parts of a block: what goes on from an earlier one, its records, and what goes on in a later one.
REST, RECORD, START = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines with the file and block they are in. The lines of a block follow each other in one task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = F.col("_metadata")
    return lines.select(
        place["file_path"].alias("file"),
        place["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )


def _opened(lines: DataFrame) -> DataFrame:
    """Whether each block of a file begins inside quotes. One row for each block."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit(QUOTE), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("opened"))


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "block", "part", "first", "record"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    current: tuple[str, int] | None = None
    texts: list[str] = []
    inside = first = False
    part = RECORD
    out: list[tuple] = []

    def close(last_part: int) -> None:
        nonlocal texts, part, first
        out.append((*current, last_part, first and current[1] == 0, "\n".join(texts)))
        texts, part, first = [], RECORD, False

    def made() -> pa.RecordBatch:
        nonlocal out
        rows, out = out, []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names)

    for batch in batches:
        for file, block, opened, text in zip(*(batch[c].to_pylist() for c in ("file", "block", "opened", "text"))):
            if (file, block) != current:
                if texts:
                    close(START if part == RECORD else REST)
                current, inside, first = (file, block), opened, True
                part = REST if opened else RECORD
            texts.append(text)
            inside ^= text.count(QUOTE) % 2 == 1
            if not inside:
                close(part)
        yield made()
    if texts:
        close(START if part == RECORD else REST)
    yield made()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text: (first, record), ``first`` for the first one of a file.

    Lines end in a line feed, with or without a carriage return; blank lines outside quotes are left out. Quotes inside
    quoted fields are doubled. A file whose last quote is not closed ends in a record that holds the rest of it.
    """
    lines = _lines(spark, path)
    opened = settled(_opened(lines))
    # Spark broadcasts the blocks while they are few, which leaves lines where and as they are; sorting then finds them in order.
    placed = lines.join(opened, ["file", "block"]).sortWithinPartitions("file", "block", "line")
    kind = "file string, block long, part int, first boolean, record string"
    parts = placed.select("file", "block", "opened", "text").mapInArrow(_assembled, kind)
    whole = parts.where(F.col("part") == RECORD)
    # At most two pieces for each block: a start, and the rests up to the next start in the file are one record.
    pieces = parts.where(F.col("part") != RECORD).select("file", "block", "part", "first", "record")
    order = Window.partitionBy("file").orderBy("block", "part")
    pieces = settled(pieces).withColumn("number", F.count_if(F.col("part") == START).over(order))
    rows = F.sort_array(F.collect_list(F.struct("block", "part", "record")))
    joined = pieces.groupBy("file", "number").agg(F.max("first").alias("first"), F.array_join(rows["record"], "\n").alias("record"))
    records = whole.select("first", "record").unionByName(joined.select("first", "record"))
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return records.where(F.col("first") | (F.col("record") != ""))


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first lines of a file."""
    names: list[str] | None = None
    lines: list[str] = []
    file = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    one = file.agg(F.min("file_path")).first()[0]
    if one is None:
        return []
    # A header may hold line feeds as well; it is taken to end within the first thousand lines.
    for row in spark.read.option("lineSep", "\n").text(one).limit(1000).toLocalIterator():
        lines.append(row.value)
        if sum(line.count(QUOTE) for line in lines) % 2 == 0:
            names = next(csv.reader(["\n".join(lines).removesuffix("\r")]), [])
            break
    return names or []


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None, rejected: str | None = None) -> DataFrame:
    """CSV with a header in each file, whose fields may hold line feeds. Large files are split among tasks.

    Without a schema all columns are text. With one, a file whose header differs fails. A record that does not fit
    the schema, in a field's type or the number of fields, fails too, unless ``rejected`` names a column for its text: then it is a row whose
    other columns hold what could be read, and that column is null for records that fit.
    """
    if schema is None:
        names = header(spark, path)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    expected = schema.fieldNames()
    if not expected:
        return spark.createDataFrame([], T.StructType([]))
    records = csv_records(spark, path)
    names = F.from_csv("record", ", ".join(f"_{i} string" for i in range(len(expected))), {"multiLine": True, "escape": QUOTE})
    found = F.concat_ws(",", *[F.concat(F.lit(QUOTE), F.coalesce(names[f"_{i}"], F.lit("")), F.lit(QUOTE)) for i in range(len(expected))])
    wanted = ",".join(f"{QUOTE}{n}{QUOTE}" for n in expected)
    complaint = F.concat(F.lit(f"the header should be {wanted} but is "), F.col("record"))
    # A header that fits is passed over, any other one ends the job.
    body = records.where(F.when(~F.col("first"), True).when(found == wanted, False).otherwise(F.raise_error(complaint).cast("boolean")))
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    options = {"escape": QUOTE, "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if rejected is None:
        options["mode"] = "FAILFAST"
    else:
        shape = shape.add(rejected, T.StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejected}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in shape)
    return body.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")


def sorted_out(df: DataFrame, rejected: str) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, and the text of those that do not. ``df`` is settled, so that it is read once."""
    df = settled(df)
    return df.where(F.col(rejected).isNull()).drop(rejected), df.where(F.col(rejected).isNotNull()).select(rejected)
