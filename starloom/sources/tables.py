"""Raw table scans.

Raw tables are the source of truth and are never modified. Each reader
selects only the columns a caller needs so the Parquet scan's ReadSchema
stays narrow (Catalyst would prune anyway; listing them keeps plans honest).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_raw(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
