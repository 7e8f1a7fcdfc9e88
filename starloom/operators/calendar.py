"""Calendar dimension (SCD type 0) and the date spine.

The row count is the number of days in the span, known before the job runs,
so the calendar is the one dimension whose broadcast size is bounded by
construction (about 365 rows a year).
"""

from __future__ import annotations

import csv
import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_key, fiscal_quarter, fiscal_year
from starloom.params import FISCAL_START_MONTH

HOLIDAY_SCHEMA = T.StructType([
    T.StructField("full_date", T.DateType(), False),
    T.StructField("is_holiday", T.BooleanType(), True),
    T.StructField("holiday_name", T.StringType(), True),
])

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds")


def days_between(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from ``start`` to ``end``, both inclusive.

    ``start``/``end`` are dates or ISO strings. Uses ``spark.range`` so the
    rows are generated in parallel.
    """
    s = _dt.date.fromisoformat(str(start)) if not isinstance(start, _dt.date) else start
    e = _dt.date.fromisoformat(str(end)) if not isinstance(end, _dt.date) else end
    n = (e - s).days + 1
    return days_from(spark, s, n)


def days_from(spark: SparkSession, start, n_days: int) -> DataFrame:
    """``n_days`` consecutive days from ``start`` (a row generator)."""
    s = str(start)
    return spark.range(n_days).select(F.date_add(F.lit(s).cast("date"), F.col("id").cast("int")).alias("d"))


def days_spanning_years(df: DataFrame, date_col: str) -> DataFrame:
    """Every day of every year touched by ``df[date_col]``, derived lazily.

    A one-row global aggregate gives the year bounds; ``sequence`` expands
    them. The output size is bounded by the calendar span, not by ``df``.
    """
    b = df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
    return b.select(F.explode(F.sequence(
        F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("d"))


def _calendar_columns(d: Column, fiscal_start: int) -> list:
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        fiscal_year(d, fiscal_start).cast("int").alias("fiscal_year"),
        fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (~F.dayofweek(d).isin(1, 7)).alias("is_weekday"),
    ]


def dim_date(days: DataFrame, fiscal_start: int = FISCAL_START_MONTH,
             holidays: DataFrame | None = None) -> DataFrame:
    """Calendar rows for the days in ``days`` (column ``d``).

    Day of week is 1 = Sunday .. 7 = Saturday. Holidays come from a seed
    (full_date, is_holiday, holiday_name); days not in the seed are not
    holidays.
    """
    cal = days.select(*_calendar_columns(F.col("d"), fiscal_start))
    if holidays is None:
        return cal.withColumn("is_holiday", F.lit(False)).withColumn(
            "holiday_name", F.lit(None).cast("string"))
    h = holidays.select(F.col("full_date").alias("_hd"), F.col("is_holiday").alias("_hh"),
                        F.col("holiday_name").alias("_hn"))
    out = cal.join(h, cal.full_date == h._hd, "left")
    return out.select(
        *[c for c in cal.columns],
        F.coalesce(F.col("_hh"), F.lit(False)).alias("is_holiday"),
        F.col("_hn").alias("holiday_name"),
    )


def date_spine(days: DataFrame, fiscal_start: int = FISCAL_START_MONTH) -> DataFrame:
    """The macro flavour of the calendar: day of week 0 = Sunday .. 6."""
    d = F.col("d")
    dow = F.dayofweek(d) - 1
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        fiscal_year(d, fiscal_start).cast("int").alias("fiscal_year"),
        dow.isin(0, 6).alias("is_weekend"),
        (~dow.isin(0, 6)).alias("is_weekday"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )


def read_holiday_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Load a holiday seed CSV with an explicit schema (no inference).

    The package's own seed (one row per holiday and year) is a file of the
    driver's installation, so the driver reads it and ships the rows; a given
    path is read by Spark.
    """
    if path is not None:
        return spark.read.csv(path, header=True, schema=HOLIDAY_SCHEMA)
    with open(os.path.join(SEED_DIR, "holidays.csv"), newline="", encoding="utf-8") as f:
        rows = [(_dt.date.fromisoformat(r["full_date"]), r["is_holiday"].lower() == "true", r["holiday_name"])
                for r in csv.DictReader(f)]
    return spark.createDataFrame(rows, HOLIDAY_SCHEMA)
