"""What the two searches share: queries are sent to shards, which stay where they are.

A shard holds a bounded number of rows, dealt by a hash of distinct values, and is one row, from which its task makes the index
once. The queries follow it in Arrow batches, so a task holds one shard and one batch, however many queries there are. What is
shuffled is each shard once and each query once per shard; what comes back is a few rows per query and shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def dealt(df: DataFrame, key: Column, rows: int) -> tuple[Column, int]:
    """A number below a count, chosen by ``key`` so that about ``rows`` rows of ``df`` share one; and the count."""
    count = max(1, -(-df.count() // rows))
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("long"), count


def answered(
    shards: DataFrame,
    queries: DataFrame,
    count: int,
    load: Callable[[dict[str, Any]], Any],
    answer: Callable[[Any, pa.RecordBatch], list[list]],
    schema: str,
) -> DataFrame:
    """The columns ``answer(load(shard), batch)`` for each shard and the batches of its queries.

    ``shards`` has one row for each number ``shard``, ``queries`` a row for each shard that a query is for; names of their other
    columns differ. ``count`` is about the number of shards.
    """
    given = [c for c in queries.columns if c != "shard"]
    both = shards.withColumn("_query", F.lit(False)).unionByName(queries.withColumn("_query", F.lit(True)), allowMissingColumns=True)
    placed = both.repartition(count, "shard").sortWithinPartitions("shard", "_query")
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for batch in batches:
            numbers, asks = batch["shard"].to_pylist(), batch["_query"].to_pylist()
            at = 0
            while at < len(numbers):
                if not asks[at]:
                    held, index = numbers[at], load(batch.slice(at, 1).to_pylist()[0])
                    at += 1
                    continue
                end = at
                while end < len(numbers) and asks[end] and numbers[end] == numbers[at]:
                    end += 1
                if numbers[at] == held:  # a shard without rows has no answers
                    columns = answer(index, batch.slice(at, end - at).select(given))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])
                at = end

    return placed.mapInArrow(run, schema)
