"""Monthly growth per channel, by six-day steps and in total, with two ranks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.functions.dates import checkpoint_days, month_before
from viewtide.operators.joins import join_null_safe
from viewtide.operators.positions import rank_rows, value_ranks
from viewtide.operators.windows import last_of_day
from viewtide.session import settled

COUNTERS = ("sub_count", "view_count", "video_count")
WEEKS = (1, 2, 3, 4)
# The days of a month whose levels are compared.
POINTS = (1, 7, 13, 19, 25)


def monthly_growth(
    channel_log: DataFrame, as_of: dt.date, whole_log: bool = False, aligned: bool = False
) -> DataFrame:
    """Growth of each counter per channel in the month before ``as_of``.

    ``<n>_sub_delta`` and so on are differences between neighbouring checkpoints.
    By default the checkpoints that are present are numbered, so a missing one
    moves later numbers down; ``aligned`` numbers them by date instead and gives
    null next to a missing one. ``whole_log`` takes the ``monthly_*`` totals over
    the whole log. Channels without any checkpoint are left out.

    Of several rows of a day the one written last counts. Where the log has no time of
    writing it is taken to have one row a day, and there is one pass and one shuffle: the
    checkpoints are picked by conditional aggregates, which are combined before the shuffle.
    """
    first, last = month_before(as_of)
    days = checkpoint_days(first)
    log = channel_log if whole_log else channel_log.where(F.col("created_date").between(first, last))
    log = last_of_day(log, "channel_id")

    def level(counter: str, day: dt.date) -> Column:
        return F.max(F.when(F.col("created_date") == F.lit(day), F.col(counter)))

    picked = [level(c, d).alias(f"_{c}_{d.day}") for d in days for c in COUNTERS]
    seen = [F.max(F.col("created_date") == F.lit(d)).alias(f"_seen_{d.day}") for d in days]
    totals = [
        (F.max_by(c, "created_date") - F.min_by(c, "created_date")).alias(
            f"monthly_{c.removesuffix('_count')}_delta"
        )
        for c in COUNTERS
    ]
    levels = log.groupBy("channel_id").agg(*picked, *seen, *totals)

    checkpoints = F.array(
        *[
            F.when(
                F.col(f"_seen_{d.day}"),
                F.struct(*[F.col(f"_{c}_{d.day}").alias(c) for c in COUNTERS]),
            )
            for d in days
        ]
    )
    present = F.filter(checkpoints, lambda c: c.isNotNull())
    levels = levels.withColumn("_points", checkpoints if aligned else present)
    deltas = []
    for week in WEEKS:
        start, end = (F.get("_points", F.lit(n)) for n in (week - 1, week))
        for c in COUNTERS:
            name = f"{week}_{c.removesuffix('_count')}_delta"
            deltas.append((end[c] - start[c]).alias(name))
    return levels.where(F.exists("_points", lambda p: p.isNotNull())).select(
        "channel_id", *deltas, *[f"monthly_{c.removesuffix('_count')}_delta" for c in COUNTERS]
    )


def month_partials(channel_log: DataFrame) -> DataFrame:
    """What the growth of each channel and month needs: its first and last levels, and those of its checkpoints.

    Columns channel_id, month, first, last and ``day_<d>``. A log of any days gives partials; ``merged_partials`` puts those of
    several logs together, so a new day costs that day and one row for each channel.
    """
    log = last_of_day(channel_log, "channel_id")
    written = F.unix_micros(F.col("created_at").cast("timestamp")) if "created_at" in log.columns else F.lit(0)
    levels = F.struct(*COUNTERS)
    month = F.trunc("created_date", "month").alias("month")
    # Of a day that is given again the row written last counts, at either end of the month.
    first = F.struct("created_date", (-F.coalesce(written, F.lit(0))).alias("written"), levels.alias("levels"))
    last = F.struct("created_date", F.coalesce(written, F.lit(0)).alias("written"), levels.alias("levels"))
    points = [F.max(F.when(F.dayofmonth("created_date") == d, last)).alias(f"day_{d}") for d in POINTS]
    rows = log.where(F.col("created_date").isNotNull())
    return rows.groupBy("channel_id", month).agg(F.min(first).alias("first"), F.max(last).alias("last"), *points)


def merged_partials(*partials: DataFrame) -> DataFrame:
    """One row for each channel and month. Days that are in several of the tables count once."""
    rows = partials[0]
    for more in partials[1:]:
        rows = rows.unionByName(more)
    points = [F.max(f"day_{d}").alias(f"day_{d}") for d in POINTS]
    return rows.groupBy("channel_id", "month").agg(F.min("first").alias("first"), F.max("last").alias("last"), *points)


def growth_of(partials: DataFrame, as_of: dt.date, aligned: bool = False) -> DataFrame:
    """``monthly_growth`` from partials."""
    first, _ = month_before(as_of)
    rows = partials.where(F.col("month") == F.lit(first))
    points = F.array(*[F.col(f"day_{d}.levels") for d in POINTS])
    present = F.filter(points, lambda p: p.isNotNull())
    rows = rows.withColumn("_points", points if aligned else present)
    deltas = []
    for week in WEEKS:
        start, end = (F.get("_points", F.lit(n)) for n in (week - 1, week))
        deltas += [(end[c] - start[c]).alias(f"{week}_{c.removesuffix('_count')}_delta") for c in COUNTERS]
    totals = [(F.col(f"last.levels.{c}") - F.col(f"first.levels.{c}")).alias(f"monthly_{c.removesuffix('_count')}_delta") for c in COUNTERS]
    return rows.where(F.size(present) > 0).select("channel_id", *deltas, *totals)


def ranked(growth: DataFrame) -> DataFrame:
    """Growth with the channels ranked by subscribers and by views gained."""
    growth = settled(growth)
    by_subs = rank_rows(growth, [], "monthly_sub_delta", "sub_ranking")
    by_views = value_ranks(growth, [], "monthly_view_delta", "view_ranking")
    return join_null_safe(by_subs, by_views, ["monthly_view_delta"])


def monthly_channel_fact(
    channel_log: DataFrame, as_of: dt.date, whole_log: bool = False, aligned: bool = False
) -> DataFrame:
    """``monthly_growth`` with the channels ranked by subscribers and by views gained."""
    return ranked(monthly_growth(channel_log, as_of, whole_log, aligned))
