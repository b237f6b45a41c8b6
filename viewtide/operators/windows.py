"""Windows over the snapshots of one key.

Of several snapshots of a day the one written last counts, so a group is no larger
than the number of days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from viewtide.operators.dedup import latest_per_key, snapshot_order


def last_of_day(log: DataFrame, key: str) -> DataFrame:
    """The snapshot of each key and day that was written last, where the log says when."""
    if "created_at" not in log.columns:
        return log
    return latest_per_key(log, [key, "created_date"], snapshot_order(log))


def snapshot_ordinal(log: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """Number the snapshots of each key from 1, by day."""
    log = last_of_day(log, key)
    return log.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy("created_date")))


def first_snapshots(log: DataFrame, key: str, count: int, name: str = "ordinal") -> DataFrame:
    """The first ``count`` snapshots of each key with their ordinal."""
    return snapshot_ordinal(log, key, name).where(F.col(name) <= count)


def checkpoint_deltas(checkpoints: DataFrame, key: str, counters: list[str]) -> DataFrame:
    """Growth of each counter until the key's next checkpoint; the fifth checkpoint only closes.

    ``sub_count`` becomes ``sub_delta``. ``week_num`` counts the checkpoints that
    are present, so a missing day moves later numbers down.
    """
    checkpoints = last_of_day(checkpoints, key)
    by_day = Window.partitionBy(key).orderBy("created_date")
    deltas = [
        (F.lead(c).over(by_day) - F.col(c)).alias(f"{c.split('_')[0]}_delta") for c in counters
    ]
    numbered = checkpoints.select(key, F.row_number().over(by_day).alias("week_num"), *deltas)
    return numbered.where(F.col("week_num") != 5)
