"""Session settings, and the shared folder for tables that cut long plans."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# All can be changed on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A join key holding a large share of the rows is split at run time, also
    # where that costs one more shuffle further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every plan in this package relies on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("viewtide")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process may fall back to a temporary folder: on a cluster,
    a local one too, the executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="viewtide-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table, in the application's own folder below the shared one.

    That folder may be deleted when the application has ended.
    """
    application = f"viewtide-{spark.sparkContext.applicationId}"
    return f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows written to a scratch table, for results that are read several times.

    Later steps start from the table: they read only the columns they need, know its
    size, and do not depend on executors that may be lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    for paths in SCOPES:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# The paths settled within each open ``scratch_scope``.
SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside when the block ends.

    For jobs that store their result inside the block; frames that still read a settled table fail afterwards.
    """
    paths: list[str] = []
    SCOPES.append(paths)
    try:
        yield
    finally:
        SCOPES.remove(paths)
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in; one that is not there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
