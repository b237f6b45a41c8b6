"""Grouped aggregates, pivots and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.operators.windows import last_of_day


def period_delta(log: DataFrame, key: str, counters: list[str], prefix: str) -> DataFrame:
    """Last level minus first level of each counter, by day. Of several rows of a day the one written last counts."""
    log = last_of_day(log, key)
    deltas = [
        (F.max_by(c, "created_date") - F.min_by(c, "created_date")).alias(
            f"{prefix}_{c.split('_')[0]}_delta"
        )
        for c in counters
    ]
    return log.groupBy(key).agg(*deltas)


def pivot_by_ordinal(
    df: DataFrame, key: str, ordinal: str, last: int, columns: dict[str, str]
) -> DataFrame:
    """One row per key with ``<ordinal>_<alias>`` columns for the ordinals 1 to ``last``.

    Giving the values spares the job that would look them up, and makes columns
    of ordinals that do not occur null rather than missing.
    """
    values = [F.first(column).alias(alias) for column, alias in columns.items()]
    wide = df.groupBy(key).pivot(ordinal, list(range(1, last + 1))).agg(*values)
    if len(columns) == 1:  # Spark leaves the alias out when there is one aggregate
        alias = next(iter(columns.values()))
        wide = wide.withColumnsRenamed({str(n): f"{n}_{alias}" for n in range(1, last + 1)})
    return wide


def side_by_side(
    df: DataFrame, key: str, ordinal: str, last: int, columns: dict[str, str]
) -> DataFrame:
    """``pivot_by_ordinal`` for rows numbered 1, 2, 3 ... without gaps, and for many ordinals.

    A pivot evaluates one condition per result column for each row. Here the at
    most ``last`` rows of a key are put into an array and picked from it once.
    """
    rows = F.collect_list(F.struct(ordinal, *columns))
    listed = df.where(F.col(ordinal) <= last).groupBy(key).agg(F.sort_array(rows).alias("_rows"))
    picked = [
        f"get(_rows, {n - 1}).`{column}` AS `{n}_{alias}`"
        for n in range(1, last + 1)
        for column, alias in columns.items()
    ]
    return listed.selectExpr(f"`{key}`", *picked)


def value_counts(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


# A double has no more significant digits.
DIGITS = 17


def bin_edges(values: DataFrame, value: str, bins: int) -> DataFrame:
    """One row: ``low`` and ``width`` of equal bins over the observed range, and label ``edges``.

    Label edges are rounded to as few digits as keep them apart; the lowest one
    is moved down by one unit of the last digit, so that it includes the minimum.
    """
    number = F.col(value).cast("double")
    # A single observed value still gets a range, a thousandth of it to either side.
    nudge = F.when(F.col("low") != F.col("high"), 0.0)
    nudge = nudge.when(F.col("low") == 0, 0.001).otherwise(F.abs("low") * 0.001)
    span = values.agg(F.min(number).alias("low"), F.max(number).alias("high")).select(
        (F.col("low") - nudge).alias("low"),
        ((F.col("high") - F.col("low") + 2 * nudge) / bins).alias("width"),
    )
    steps = F.sequence(F.lit(0), F.lit(bins))
    exact = span.withColumn(
        "edges", F.transform(steps, lambda i: F.col("low") + i * F.col("width"))
    )
    choices = []
    for digits in range(DIGITS):
        near = F.transform("edges", lambda edge: F.bround(edge, digits))
        lowered = F.concat(F.array(F.get(near, F.lit(0)) - 10.0**-digits), F.slice(near, 2, bins))
        choices.append(F.when(F.size(F.array_distinct(near)) == bins + 1, lowered))
    return exact.withColumn("edges", F.coalesce(*choices, "edges"))


def equal_width_bins(df: DataFrame, value: str, bins: int, values: DataFrame | None = None):
    """Add ``bin`` (1 to ``bins``) and ``label`` for right-closed bins over the observed range.

    The range is that of ``values`` (default: ``df``), read by a one-row subquery.
    """
    span = bin_edges(df if values is None else values, value, bins)
    place = F.ceil((F.col(value) - F.col("_span.low")) / F.col("_span.width"))
    place = F.greatest(F.lit(1), F.least(F.lit(bins), place))
    left, right = [F.get("_span.edges", F.col("bin") - n).cast("long") for n in (1, 0)]
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("_span", span.select(F.struct("low", "width", "edges")).scalar())
        .withColumn("bin", place.cast("int"))
        .withColumn("label", F.concat_ws("~", left, right))
        .drop("_span")
    )
