"""Workload analytics, run as Spark jobs.

- ``files_holding``: of a table's data files, how many hold rows of a filter
  (a scan of the filter's columns; what a layout could prune down to).
- ``job_log_report``: workload summary over a job log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import whole_seconds


def files_holding(table: DataFrame, condition: Column) -> DataFrame:
    """files_total, files_hit, bytes_total, bytes_hit of a scanned table."""
    per = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.max(condition.cast("int")).alias("hit"))
    return per.agg(
        F.count(F.lit(1)).alias("files_total"), F.sum("hit").cast("long").alias("files_hit"),
        F.sum("bytes").cast("long").alias("bytes_total"),
        F.sum(F.col("bytes") * F.col("hit")).cast("long").alias("bytes_hit"))


def job_log_report(log: DataFrame, as_of=None, k: int = 50) -> DataFrame:
    """Newest ``k`` QUERY jobs created in the day before ``as_of`` (ties by
    job id). Without ``as_of`` the newest job's creation time is used (a
    lazy scalar subquery)."""
    if as_of is None:
        now = log.agg(F.max("creation_time")).scalar()
    elif isinstance(as_of, Column):
        now = as_of
    else:
        now = F.lit(as_of).cast("timestamp_ntz")
    recent = log.filter((F.col("creation_time") >= now - F.expr("INTERVAL 1 DAY"))
                        & (F.col("job_type") == "QUERY"))
    return recent.select(
        "job_id", "statement_type",
        (F.col("total_bytes_processed") / F.pow(F.lit(10), F.lit(9))).alias("gb_processed"),
        (F.col("total_slot_ms") / 1000).alias("slot_seconds"),
        whole_seconds("start_time", "end_time").alias("wall_seconds"),
        "query", "creation_time",
    ).orderBy(F.desc("creation_time"), "job_id").limit(k)
