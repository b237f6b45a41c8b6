"""Scans: parquet, CSV, JDBC, SQL text, id lists and stored documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CSV = {
    "header": True,
    "escape": '"',  # quoted fields may hold commas and doubled quotes
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Layout of tables by a key with many values: the partition column, and how many values it has by default.
BUCKET = "key_bucket"
BUCKETS = 64


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Without a schema all columns are text.

    With a schema the header must match it, so columns in another order fail
    instead of being read as each other. Large files are split among tasks. Where
    fields may hold line feeds, ask for ``multi_line``, which costs one more pass.
    """
    if multi_line:
        from viewtide.sources.records import read_csv_records

        return read_csv_records(spark, path, schema)
    reader = spark.read.options(**CSV)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def key_bucket(key: Column, buckets: Column) -> Column:
    """The bucket of a key among so many, as ``7of64``: the table itself says how many it has."""
    number = F.pmod(F.xxhash64(key), buckets)
    return F.concat_ws("of", number.cast("string"), buckets.cast("string"))


def rows_of_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """The rows of one key of a table laid out by key; other buckets are not read."""
    buckets = F.substring_index(F.col(BUCKET), "of", -1).cast("int")
    chosen = table.where((F.col(BUCKET) == key_bucket(F.lit(value), buckets)) & (F.col(key) == value))
    return chosen.drop(BUCKET)


def read_csv_inferred(
    spark: SparkSession, path: str, sample: float = 1.0, multi_line: bool = False
) -> DataFrame:
    """CSV with types inferred from a share of the rows, at the cost of one more pass."""
    reader = spark.read.options(**CSV, multiLine=multi_line)
    return reader.options(inferSchema=True, samplingRatio=sample).csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel ranges of a number, date or timestamp column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties or {},
    )


def day_predicates(column: str, first: dt.date, last: dt.date) -> list[str]:
    """One predicate per day, to be read as one partition each."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return [f"{column} = DATE '{day}'" for day in days]


def read_jdbc_days(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    first: dt.date,
    last: dt.date,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The given days of a log table, one task per day."""
    return spark.read.jdbc(
        url, table, predicates=day_predicates(column, first, last), properties=properties or {}
    )


def read_jdbc_query(
    spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """The result of a query run by the database."""
    options = {"url": url, "query": query, **(properties or {})}
    return spark.read.format("jdbc").options(**options).load()


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """SQL text over the given DataFrames, named in braces: ``select * from {video}``."""
    return spark.sql(query, **tables)


def read_id_list(spark: SparkSession, path: str, name: str = "channel_id") -> DataFrame:
    """Ids from comma-separated text files, one row per id.

    The comma is taken as the line separator, so that a long list is split
    among tasks although it is a single line.
    """
    ids = spark.read.text(path, lineSep=",")
    squeezed = F.regexp_replace("value", r"\s", "")
    return ids.select(squeezed.alias(name)).where(F.col(name) != "")


def read_documents(spark: SparkSession, path: str, name: str = "body") -> DataFrame:
    """Stored JSON or HTML files, one row per file with its path."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias(name))
