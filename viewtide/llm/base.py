"""What the operators of this package share: session, tables, whole rows, the query registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from viewtide.session import settled, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Rows in one Arrow batch. A row holds a whole text, so few rows go together.
BATCH_ROWS = "1000"

# What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def prepared(spark: SparkSession) -> SparkSession:
    """Apply the settings of the library and small Arrow batches."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the test data."""
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL for its rows if there is one."""

    def register(function: Query) -> Query:
        name = function.__name__
        assert name not in QUERIES, name
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# What a Python worker keeps for later tasks.
KEPT: dict[tuple, object] = {}


def kept(make: Callable) -> Callable:
    """``make`` with its last result kept in a Python worker, until this or another such function makes a new one.

    Workers outlive a stage, so what one stage no longer needs would take the memory of those that follow.
    """

    @wraps(make)
    def get(*key):
        place = (make.__module__, make.__name__, key)
        if place not in KEPT:
            KEPT.clear()
            KEPT[place] = make(*key)
        return KEPT[place]

    return get


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows as one struct ``row`` beside ``columns``, so that no name of theirs can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unboxed(df: DataFrame) -> DataFrame:
    """The rows of a boxed table as they were."""
    return df.select("row.*")


def text_or_empty(column: str = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """``df`` if it is a Parquet table as read, else its rows written to the shared folder."""
    if df._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            df.select(df.metadataColumn("_metadata")["row_index"])
            return df
        except AnalysisException:
            pass
    return settled(df)


def keyed(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows of a ``stored`` table as ``row``, their ``key``, and ``columns``.

    A key is the file and the place in it, so a row has the same one whenever and wherever the table is read. Decisions
    about rows can thus be worked out on a few columns and be met with the whole rows later, which need not be copied.
    """
    place = df.metadataColumn("_metadata")
    key = F.struct(place["file_path"].alias("file"), place["row_index"].alias("at"))
    return boxed(df, key=key, **columns)
