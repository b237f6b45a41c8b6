"""The star schema from the extracted raw tables, written table by table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from viewtide.plans.dimensions import channel_dimension, time_dimension
from viewtide.plans.extract import extract
from viewtide.plans.monthly_channel_fact import monthly_channel_fact
from viewtide.plans.video_fact import video_fact
from viewtide.sources.readers import read_parquet
from viewtide.sources.writers import write_csv, write_table

RAW = ("video", "video_log", "channel", "channel_log")


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_parquet(spark, f"{folder}/{name}_raw.parquet") for name in RAW}


def star_schema(spark: SparkSession, raw: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The four tables; the monthly fact is that of the month before ``as_of``."""
    return {
        "time_dimension": time_dimension(spark),
        "channel_dimension": channel_dimension(raw["channel"]),
        "monthly_channel_fact": monthly_channel_fact(raw["channel_log"], as_of),
        "video_fact_table": video_fact(raw["video"], raw["video_log"], raw["channel_log"]),
    }


def build(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    raw_folder: str,
    olap_folder: str,
    as_of: dt.date,
    csv: bool = False,
) -> dict[str, str]:
    """Extract the operational tables, derive the star schema and return its paths."""
    extract({name: tables[name] for name in RAW}, raw_folder)
    write, suffix = (write_csv, "csv") if csv else (write_table, "parquet")
    paths = {}
    for name, df in star_schema(spark, read_raw(spark, raw_folder), as_of).items():
        paths[name] = f"{olap_folder}/{name}.{suffix}"
        write(df, paths[name])
    return paths
