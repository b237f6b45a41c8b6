"""Declared constraints as tables of violations; an empty table means all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from viewtide.schema import CONSTRAINTS


def primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a null."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where((F.col("rows") > 1) | has_null)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counted.where("rows > 1")


def _unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of counts to (column, rows), without the zero counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in columns])
    return df.select(F.inline(pairs)).where("rows > 0")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with nulls and how many; one pass for all columns."""
    return _unpivot(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), columns)


def length(df: DataFrame, exact: dict[str, int], longest: dict[str, int]) -> DataFrame:
    """Columns with texts of a wrong length and how many; one pass for all columns."""
    wrong = {c: F.char_length(c) != n for c, n in exact.items()}
    wrong |= {c: F.char_length(c) > n for c, n in longest.items()}
    return _unpivot(df.agg(*[F.count_if(bad).alias(c) for c, bad in wrong.items()]), list(wrong))


def in_set(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Values outside the allowed set and how often they occur."""
    outside = df.where(~F.col(column).isin(allowed))
    return outside.groupBy(column).agg(F.count("*").alias("rows"))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null references without a parent and how often they occur.

    References are counted first: a value used by most child rows joins as one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(column))
    return used.join(known, column, "left_anti")


def row_rules(df: DataFrame, rules: dict) -> DataFrame:
    """(constraint, column, rows) of the rules that one row can break; one pass for all of them."""
    wrong = [("not null", c, F.col(c).isNull()) for c in rules.get("required", [])]
    wrong += [("length", c, F.char_length(c) != n) for c, n in rules.get("exact", {}).items()]
    wrong += [("length", c, F.char_length(c) > n) for c, n in rules.get("longest", {}).items()]
    wrong += [("check", c, ~F.col(c).isin(allowed)) for c, allowed in rules.get("allowed", {}).items()]
    counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(wrong)])
    named = [
        F.struct(F.lit(rule).alias("constraint"), F.lit(c).alias("column"), F.col(f"_{i}").alias("rows"))
        for i, (rule, c, _) in enumerate(wrong)
    ]
    return counts.select(F.inline(F.array(*named)))


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows violating each declared constraint: (table, constraint, column, rows)."""

    def summed(table, constraint, column, violations, rows="rows"):
        total = violations.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("rows"))
        return total.select(
            F.lit(table).alias("table"), F.lit(constraint).alias("constraint"),
            F.lit(column).alias("column"), "rows",
        )

    parts = []
    for name, df in tables.items():
        rules = CONSTRAINTS[name]
        if keys := rules.get("primary"):
            parts.append(summed(name, "primary key", ", ".join(keys), primary_key(df, keys)))
        for column in rules.get("unique", []):
            parts.append(summed(name, "unique", column, unique(df, column)))
        if any(rules.get(kind) for kind in ("required", "exact", "longest", "allowed")):
            parts.append(row_rules(df, rules).select(F.lit(name).alias("table"), "*"))
        for column, (parent, key) in rules.get("refers", {}).items():
            if parent in tables:
                orphans = foreign_key(df, column, tables[parent], key)
                parts.append(summed(name, "foreign key", column, orphans))
    return reduce(DataFrame.unionByName, parts).where("rows > 0")
