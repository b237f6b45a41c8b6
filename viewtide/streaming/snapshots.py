"""Daily counter snapshots from files that keep arriving.

The log keeps one row per id and day. Repeats within one batch are dropped by
the batch itself, repeats of earlier batches by comparing with the days already
in the log, so a batch that is run again after a failure adds nothing.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtide.operators.dedup import latest_per_key
from viewtide.operators.joins import not_stored
from viewtide.session import settled
from viewtide.sources.writers import append


def append_new_days(batch: DataFrame, log_path: str, key: str) -> int:
    """Append the snapshots whose (id, day) the log does not hold yet, and return how many.

    Rows without an id or a day cannot be told from stored ones and are left out. Of the log only
    the days from the batch's first to its last are read back.
    """
    order = ["created_at"] if "created_at" in batch.columns else []
    known = batch.where(F.col(key).isNotNull() & F.col("created_date").isNotNull())
    new = settled(latest_per_key(known, [key, "created_date"], order))
    first, last = new.agg(F.min("created_date"), F.max("created_date")).first()
    if first is None:
        return 0

    # An empty append creates the folder, so that the first batch can read it.
    new.limit(0).write.partitionBy("created_date").parquet(log_path, mode="append")
    stored = batch.sparkSession.read.schema(new.schema).parquet(log_path)
    days = stored.where(F.col("created_date").between(first, last))
    unseen = not_stored(new, days, [key, "created_date"])
    return append(unseen, log_path, new.schema, partition_by="created_date")


def ingest(stream: DataFrame, log_path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Process all files present, then stop; the next call goes on from there."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: append_new_days(batch, log_path, key))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_repeats(stream: DataFrame, key: str, lateness: str) -> DataFrame:
    """Drop repeats of (id, day) arriving within ``lateness`` of each other.

    For sinks that cannot be compared with. State is kept for ``lateness`` only;
    rows that are later than that are dropped, so it has to cover the longest delay.
    """
    timed = stream.withColumn("_day", F.col("created_date").cast("timestamp"))
    kept = timed.withWatermark("_day", lateness).dropDuplicatesWithinWatermark([key, "_day"])
    return kept.drop("_day")
