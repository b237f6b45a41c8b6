"""Cleaning and casting of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def cast_counters(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text counters to long; text that is not a number becomes null."""
    return df.withColumns({name: F.col(name).try_cast("long") for name in columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def fill_text(df: DataFrame, filler: str = "NULL") -> DataFrame:
    """A literal in place of null in every text column."""
    return df.na.fill(filler)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Only the rows without any null."""
    return df.na.drop("any", subset=columns)
