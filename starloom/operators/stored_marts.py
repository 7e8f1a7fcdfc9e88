"""Aggregate tables that are stored and kept up to date from a fact's merges.

``order_days`` holds one row per order day, channel, customer and order; all
three marts come from it. It and the daily mart are partitioned by month like
the fact. A merge names the partitions it changes before it changes them
(file ``stale``), and afterwards those months are worked out again from the fact's
partitions and replaced: nothing else is read or written. Replacing is the same
whenever it is done, so a merge or a refresh that was broken off is made good by
the next run. Distinct orders are counted over ``order_days``, not added up, so
an order that spans months or partitions counts once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import month_start
from starloom.functions.money import TOTAL
from starloom.operators import layout
from starloom.session import released_shuffles

ORDER_DAYS, DAILY, STALE = "order_days", "daily_revenue", "stale"
MONEY_COLS = ("gross_revenue", "net_revenue", "gross_profit")


def order_days(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date", "channel", "customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("order_lines"), F.sum("quantity").cast("long").alias("units"),
        *[F.sum(c).cast(TOTAL).alias(c) for c in MONEY_COLS],
        F.sum(F.col("return_flag").cast("int")).cast("long").alias("returns"))


def daily_revenue(days: DataFrame) -> DataFrame:
    return days.groupBy("order_date", "channel").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("order_lines").alias("order_lines"), F.sum("units").alias("units"),
        *[F.sum(c).cast(TOTAL).alias(c) for c in MONEY_COLS], F.sum("returns").alias("returns"))


def cohort(days: DataFrame) -> DataFrame:
    """Customers and revenue by first-order month and months since, from one row per customer and month."""
    per = days.groupBy("customer_id", month_start("order_date").alias("order_month")).agg(F.sum("net_revenue").alias("net_revenue"))
    first = per.groupBy("customer_id").agg(F.min("order_month").alias("cohort_month"))
    months = (F.year("order_month") - F.year("cohort_month")) * 12 + F.month("order_month") - F.month("cohort_month")
    return per.join(first, "customer_id").groupBy("cohort_month", months.cast("int").alias("months_since")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("net_revenue").cast(TOTAL).alias("net_revenue"))


def channel_performance(days: DataFrame) -> DataFrame:
    per = days.groupBy("channel").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("order_lines").alias("order_lines"),
        F.sum("net_revenue").cast(TOTAL).alias("revenue"), F.sum("returns").alias("returns"))
    return per.select("*", (F.col("returns").cast("double") / F.col("order_lines")).alias("return_rate"),
                      (F.col("revenue").cast("double") / F.col("orders")).alias("avg_order_value"))


class StoredMarts:
    """The marts of the fact at ``fact_path`` (month partitions), stored under ``root``."""

    def __init__(self, spark: SparkSession, fact_path: str, root: str):
        self.spark, self.fact_path, self.root = spark, fact_path, root

    def days(self) -> DataFrame:
        return layout.without_partition_col(self.spark.read.parquet(f"{self.root}/{ORDER_DAYS}"))

    def daily(self) -> DataFrame:
        return layout.without_partition_col(self.spark.read.parquet(f"{self.root}/{DAILY}"))

    def cohort(self) -> DataFrame:
        return cohort(self.days())

    def channels(self) -> DataFrame:
        return channel_performance(self.days())

    def build(self) -> StoredMarts:
        """All months, from the whole fact."""
        months = self.spark.read.parquet(self.fact_path).select(layout.PARTITION_COL).distinct().collect()  # a row a month
        self.mark([r[0] for r in months])
        return self.refresh()

    def merge(self, source: DataFrame, merge_fn, **kw) -> StoredMarts:
        """``layout.merge_into`` the fact, then the months that it changed."""
        layout.merge_into(self.spark, self.fact_path, source, merge_fn, decided=self.mark, **kw)
        return self.refresh()

    def stale(self) -> list:
        """Months that a merge may have changed since the last refresh."""
        months = set()
        for path in self._lists():
            if layout.path_exists(self.spark, path):
                months |= set(json.loads(self.spark.read.text(path, wholetext=True).first()[0]))
        return sorted(months, key=str)

    def _lists(self) -> list[str]:
        return [f"{self.root}/{STALE}", f"{self.root}/{STALE}.next"]

    def mark(self, months: list) -> None:
        """Add to the stale months; the new list is there whole before the old one goes."""
        now, following = self._lists()
        text = json.dumps(sorted({None if m is None else str(m) for m in months} | set(self.stale()), key=str))
        for path in (following, now):
            self._drop(path)
            layout.publish(self.spark, path, text)
        self._drop(following)

    def _drop(self, path: str) -> None:
        fs, p, _ = layout._fs(self.spark, path)
        fs.delete(p, False)

    def refresh(self) -> StoredMarts:
        """Work out the stale months again."""
        months = self.stale()
        if months:
            col = layout.PARTITION_COL
            layout.recover(self.spark, self.fact_path)
            fact = self.spark.read.parquet(self.fact_path)
            known = [m for m in months if m is not None]
            chosen = F.col(col).isin([F.lit(m).cast("date") for m in known]) if known else F.lit(False)
            chosen = chosen | F.col(col).isNull() if None in months else chosen
            with released_shuffles(self.spark):
                layout.replace_partitions(self.spark, layout.with_partition_col(order_days(fact.filter(chosen))), f"{self.root}/{ORDER_DAYS}", col, months)
                days = self.spark.read.parquet(f"{self.root}/{ORDER_DAYS}").filter(chosen)  # as just stored
                layout.replace_partitions(self.spark, layout.with_partition_col(daily_revenue(days)), f"{self.root}/{DAILY}", col, months)
            for path in self._lists():
                self._drop(path)
        return self
