"""Copies of the raw tables, which the other jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from viewtide.sources.writers import write_table

PARTITIONED = {"video_log": "created_date", "channel_log": "created_date"}


def extract(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each table to ``folder`` and return the paths. Logs are laid out by day."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}_raw.parquet"
        write_table(df, paths[name], PARTITIONED.get(name))
    return paths
