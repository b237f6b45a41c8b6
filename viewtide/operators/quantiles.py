"""Exact quantiles in groups of any size.

The built-in ``percentile`` holds all distinct values of a group in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.operators.joins import join_null_safe
from viewtide.operators.positions import running_total
from viewtide.session import settled

# The sketch is off by at most 1 / ACCURACY of a group's rows; brackets reach twice as far.
ACCURACY = 10000
SLACK = 2 / ACCURACY


def place_values(
    df: DataFrame, keys: list[str], value: str, weight: Column | None = None
) -> DataFrame:
    """Distinct non-null values per group with ``rows`` and the number of rows ``before`` them."""
    rows = F.count("*") if weight is None else F.sum(weight)
    tally = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(rows.alias("rows"))
    return running_total(tally, keys, [F.asc(value)], F.col("rows"), "before")


def quantiles(placed: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles from the output of ``place_values``.

    ``points`` maps result columns to fractions; ``rows`` is the group size.
    """
    sizes = placed.groupBy(*keys).agg(F.sum("rows").alias("_size"))
    sized = join_null_safe(placed, sizes, keys)

    def value_at(index: Column) -> Column:
        covers = (F.col("before") <= index) & (index < F.col("before") + F.col("rows"))
        return F.max(F.when(covers, F.col(value).cast("double")))

    found, results = [], []
    for name, fraction in points.items():
        position = F.lit(fraction) * (F.col("_size") - 1)
        found += [
            value_at(F.floor(position)).alias(f"_low_{name}"),
            value_at(F.ceil(position)).alias(f"_high_{name}"),
        ]
        share = position - F.floor(position)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        results.append((low + (high - low) * share).alias(name))
    grouped = sized.groupBy(*keys, "_size").agg(*found)
    return grouped.select(*keys, F.col("_size").alias("rows"), *results)


def _coarsened(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Values near a quantile as they are; all others as one stand-in per gap, marked ``_far``."""
    reaches = [(max(q - SLACK, 0.0), min(q + SLACK, 1.0)) for q in sorted(points.values())]
    ends = [end for reach in reaches for end in reach]
    brackets = settled(
        df.groupBy(*keys).agg(
            F.percentile_approx(value, ends, ACCURACY).alias("_ends"), F.min(value).alias("_least")
        )
    )
    rows = join_null_safe(df, brackets, keys)

    number = F.col(value)
    lows = [F.get("_ends", F.lit(2 * n)) for n in range(len(reaches))]
    highs = [F.get("_ends", F.lit(2 * n + 1)) for n in range(len(reaches))]
    near = reduce(or_, [number.between(low, high) for low, high in zip(lows, highs)])
    # The end of the last bracket below, or the least value if there is none.
    passed = F.coalesce(*[F.when(number > high, high) for high in reversed(highs)], "_least")
    return rows.select(*keys, F.when(near, number).otherwise(passed).alias(value), (~near).alias("_far"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Quantiles of a large table, and the number of non-null ``rows``, per group.

    A first pass brackets each quantile with a sketch. The second pass counts the
    values outside the brackets and shuffles and sorts only those inside, a small
    part of the rows. A group whose bracket proves wrong is worked out in full.
    ``df`` is read twice, so settle it first if it is costly.
    """
    df = df.select(*keys, value).where(F.col(value).isNotNull())
    coarse = _coarsened(df, keys, value, points)
    tally = coarse.groupBy(*keys, value, "_far").agg(F.count("*").alias("rows"))
    order = [F.asc(value), F.asc("_far")]
    placed = running_total(tally, keys, order, F.col("rows"), "before")
    placed = placed.withColumn(value, F.when(~F.col("_far"), F.col(value)))
    found = settled(quantiles(placed, keys, value, points))

    hit = F.lit(True)
    for name in points:
        hit = hit & F.col(name).isNotNull()
    missed = found.where(~hit)
    if missed.isEmpty():
        return found
    rest = join_null_safe(df, missed.select(*keys), keys, "left_semi")
    return found.where(hit).unionByName(
        quantiles(place_values(rest, keys, value), keys, value, points)
    )


def medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact median and number of rows per group."""
    return exact_quantiles(df, keys, value, {"median": 0.5})


def approximate_medians(df: DataFrame, keys: list[str], value: str, accuracy: int = 10000) -> DataFrame:
    """Median by a sketch of bounded size, in one shuffle."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("rows"), F.percentile_approx(value, 0.5, accuracy).alias("median")
    )


# The size of a stored sketch. A quantile it gives is off by about a hundredth of the ranks at 200, and exact for fewer values.
SKETCH = 200


def value_sketches(df: DataFrame, group: list[str], value: str, size: int = SKETCH) -> DataFrame:
    """A KLL sketch of the values (numbers) of each group, as ``sketch``, to be stored.

    For quantiles of groups that keep growing: a day's sketches are merged with those of other days by
    ``sketched_quantiles`` without reading its rows again. Nulls are not counted; a group of nulls has no row.
    """
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*group).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, group: list[str], shares: dict[str, float]) -> DataFrame:
    """Approximate quantiles of each group over all its sketches, and how many values they hold."""
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    columns = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in shares.items()]
    return merged.select(*group, F.kll_sketch_get_n_double("sketch").alias("rows"), *columns)
