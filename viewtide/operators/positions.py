"""Ranks, row numbers and running totals in groups of any size.

A window gathers each of its groups in one task. Here the rows are first cut
into pieces, each a contiguous range of the sort order, so a large group covers
several pieces. Rows are counted within their piece, and a piece that continues
a group adds what the group had in earlier pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from viewtide.operators.joins import join_null_safe
from viewtide.session import settled

PIECE = "_piece"


def cut(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Range-partition by ``keys`` and ``order`` and note each row's piece.

    The result is read more than once and the cut points come from a sample, so
    it is written out: a lost executor must not lead to different pieces.
    """
    pieces = df.repartitionByRange(*keys, *order)
    return settled(pieces.withColumn(PIECE, F.spark_partition_id()))


def running_total(
    df: DataFrame, keys: list[str], order: list[Column], amount: Column, name: str
) -> DataFrame:
    """Sum of ``amount`` (a long) over the rows of the group that sort before this one.

    ``order`` must be unique within a group.
    """
    pieces = cut(df.withColumn("_amount", amount.cast("long")), keys, order)

    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.groupBy(*keys, PIECE)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_carried", F.sum("_sum").over(earlier))
        .where("_carried is not null")
        .select(*keys, PIECE, "_carried")
    )
    within = (
        Window.partitionBy(*keys, PIECE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = pieces.withColumn("_within", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    # A piece continues at most one group, so there is at most one row per piece to broadcast.
    joined = join_null_safe(counted, F.broadcast(carried), [*keys, PIECE], "left")
    total = F.col("_within") + F.coalesce("_carried", F.lit(0))
    return joined.select(*df.columns, total.alias(name))


def number_rows(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` from 1 per group."""
    placed = running_total(df, keys, order, F.lit(1), name)
    return placed.withColumn(name, F.col(name) + 1)


def value_ranks(
    df: DataFrame, keys: list[str], column: str, name: str, descending: bool = True
) -> DataFrame:
    """The ``rank`` of each distinct value per group, or over all rows if ``keys`` is empty.

    A value shared by many rows is counted before the shuffle and placed as one row.
    """
    order = F.desc(column) if descending else F.asc(column)
    values = df.groupBy(*keys, column).agg(F.count("*").alias("_rows"))
    placed = running_total(values, keys, [order], F.col("_rows"), name)
    return placed.select(*keys, column, (F.col(name) + 1).alias(name))


def rank_rows(
    df: DataFrame, keys: list[str], column: str, name: str, descending: bool = True
) -> DataFrame:
    """Add the ``rank`` of a value. ``df`` is read twice, so settle it first if it is costly."""
    ranks = value_ranks(df, keys, column, name, descending)
    return join_null_safe(df, ranks, [*keys, column])
