"""Sinks: table snapshots, CSV, partitioned folders, appends and updates."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F, types as T

from viewtide.sources.readers import BUCKET, BUCKETS, CSV, key_bucket, run_sql


def _laid_out(df: DataFrame, partition_by: str | None) -> DataFrameWriter:
    """A writer by partition column, or without one.

    Rows are rebalanced by that column: one file for a small value, and several
    for a value that holds most of the rows.
    """
    if partition_by is None:
        return df.write
    return df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a parquet table."""
    _laid_out(df, partition_by).mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a CSV table, with a header in each file."""
    _laid_out(df, partition_by).options(**CSV).mode("overwrite").csv(path)


def write_by_key(
    df: DataFrame, path: str, key: str, csv: bool = False, buckets: int = BUCKETS
) -> None:
    """Replace a table laid out by a key that has too many values for a folder each.

    Rows are put into hash buckets and sorted by key, so ``rows_of_key`` reads one
    bucket, and of parquet files only the part that holds the key. The number of
    buckets should grow with the table; folder names carry it to the reader.
    """
    bucketed = df.withColumn(BUCKET, key_bucket(F.col(key), F.lit(buckets)))
    ordered = bucketed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, key)
    writer = ordered.write.partitionBy(BUCKET).mode("overwrite")
    writer.options(**CSV).csv(path) if csv else writer.parquet(path)


def export_csv(spark: SparkSession, query: str, path: str, **tables: DataFrame) -> None:
    """Write the result of a query as CSV with a header."""
    write_csv(run_sql(spark, query, **tables), path)


def align(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Columns by name in the table's order and types.

    A default stands for a column that is left out; a null in the rows stays null.
    """
    columns = []
    for field in schema:
        if field.name in df.columns:
            value = F.col(field.name)
        else:
            default = (defaults or {}).get(field.name)
            value = default if isinstance(default, Column) else F.lit(default)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def append(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    defaults: dict[str, object] | None = None,
    partition_by: str | None = None,
) -> int:
    """Append rows to a parquet table and return how many."""
    counted = Observation()
    rows = align(df, schema, defaults).observe(counted, F.count("*").alias("rows"))
    _laid_out(rows, partition_by).mode("append").parquet(path)
    return observed_rows(counted)


def observed_rows(counted: Observation) -> int:
    """The ``rows`` of an observation whose table has been written.

    Where Spark finds before running that there is nothing to write, it drops the
    count along with the plan, and reading it fails.
    """
    try:
        return counted.get["rows"]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch: int = 10000
) -> None:
    """Append rows to a database table, columns matched by name."""
    options = {"batchsize": str(batch), **(properties or {})}
    df.write.jdbc(url, table, mode="append", properties=options)


def updated(
    df: DataFrame, where: Column, values: dict[str, Column], counted: Observation | None = None
) -> DataFrame:
    """The table with new values in the rows that meet the condition.

    After the result has been written, ``counted`` holds the number of ``rows`` changed.
    """
    if counted is not None:
        df = df.observe(counted, F.count_if(where).alias("rows"))
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def update_table(
    spark: SparkSession, name: str, folder: str, change: Callable[[DataFrame, Observation], DataFrame]
) -> int:
    """Store a changed form of a catalog table and return how many rows changed.

    ``change`` takes the table and the observation that ``updated`` counts by. Its result
    is written to a new version below ``folder``, and then the table is pointed to it. A
    failure before that leaves the table as it was, and earlier versions stay for queries
    that are reading them.
    """
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        raise ValueError(f"{name} is partitioned: use update_partitions")
    counted = Observation()
    table = spark.table(name)
    version = f"{folder}/version-{uuid.uuid4().hex}"
    change(table, counted).select(*table.columns).write.parquet(version)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(name)
    return observed_rows(counted)


def update_partitions(spark: SparkSession, path: str, partition_by: str, where: Column, values: dict[str, Column]) -> int:
    """Store new values in the rows of a partitioned parquet table that meet the condition, and return how many changed.

    The partitions that hold such rows are found first, by reading the columns of the condition, and only they
    are read in full and written again. Files of other partitions are neither read nor written. The new files take the place
    of the old ones when all of them are written, so a failure before leaves the table as it was.
    """
    if partition_by in values:
        raise ValueError(f"{partition_by} says where a row is stored and cannot be changed")
    table = spark.read.parquet(path)
    # One row for each partition that changes.
    touched = [r[0] for r in table.where(where).select(partition_by).distinct().collect()]
    if not touched:
        return 0
    chosen = F.col(partition_by).isin([v for v in touched if v is not None])
    if None in touched:
        chosen = chosen | F.col(partition_by).isNull()
    counted = Observation()
    rows = updated(table.where(chosen), where, values, counted).select(*table.columns)
    writer = _laid_out(rows, partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return observed_rows(counted)


def drop_versions(spark: SparkSession, name: str, folder: str) -> int:
    """Delete the versions that ``update_table`` left below ``folder`` and the table no longer points to; return how many.

    For times at which no query reads them.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    current = rows[0].data_type.rstrip("/").rsplit("/", 1)[-1]
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = files.Path(folder)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(root) if s.isDirectory()]
    old = [n for n in names if n.startswith("version-") and n != current]
    for version in old:
        store.delete(files.Path(root, version), True)
    return len(old)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Store a catalog table in hash buckets of ``key``, sorted within each, and return it.

    Joins and groupings by that key find its rows together, so the table is not shuffled again. Each bucket is one file,
    so their number should grow with the table, and be the same for tables that are joined with each other.
    """
    laid_out = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    laid_out.option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
