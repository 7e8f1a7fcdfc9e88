"""Order lines stored under the month of their order, so that a batch of a few
order days reads the lines of its months and no others.

Raw lines carry no order date. Each arriving batch of lines meets the orders once,
by a shuffle on the order key, and is merged into a table partitioned by order
month and sorted by order day. Lines whose order is unknown or undated wait in the
partition without a date and are tried again by ``settle``. Writes are the merges of
``operators.layout``: one that is broken off is made good by the next writer.

Defined results: a line id is one line (of several rows the one shipped last
stays); lines without an id are one line; an empty batch changes nothing, and a store that
has had no line yet cannot be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import layout, upsert
from starloom.sources.staging import LINE_COLS, order_line_id

KEY, DAY = layout.TIEBREAK, "order_date"


class LineStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self) -> bool:
        return layout.path_exists(self.spark, f"{self.path}/_SUCCESS")

    def _merge(self, rows: DataFrame) -> None:
        layout.merge_into(self.spark, self.path, rows, lambda t, s: upsert.upsert(
            t, s, update_cols="all", null_safe=True, order_by="l_shipdate", loaded_col=None), layout="date")

    def add(self, lines: DataFrame, orders: DataFrame) -> None:
        """Store arrived lines; ``orders`` gives the days of their orders."""
        rows = dated(lines, orders)
        if self._exists():
            return self._merge(rows)
        layout.write_layout(upsert.dedupe_source(rows, KEY, "l_shipdate").select(*rows.columns), self.path, "date")

    def settle(self, orders: DataFrame) -> None:
        """Move waiting lines to the months of orders that have come meanwhile."""
        layout.recover(self.spark, self.path)
        found = dated(self.waiting(), orders).where(F.col(DAY).isNotNull())
        self._merge(found)

    def waiting(self) -> DataFrame:
        return self._read().where(F.col(layout.PARTITION_COL).isNull()).select(*LINE_COLS)

    def between(self, since=None, until=None) -> DataFrame:
        """Raw lines of orders of these days: literals, pushed to partitions and row groups."""
        rows = self._read()
        for bound, low in ((since, True), (until, False)):
            if bound is not None:
                day = F.lit(str(bound)).cast("date")
                month = F.trunc(day, "month")
                rows = rows.where(F.col(layout.PARTITION_COL) >= month).where(F.col(DAY) >= day) if low \
                    else rows.where(F.col(layout.PARTITION_COL) <= month).where(F.col(DAY) <= day)
        return rows.select(*LINE_COLS)

    def batch_report(self, since) -> DataFrame:
        """How many lines there are, how many lie in the months that a batch from ``since`` on reads, and how many it is."""
        day = F.lit(str(since)).cast("date")
        return self._read().agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col(layout.PARTITION_COL) >= F.trunc(day, "month")).alias("lines_in_months"),
            F.count_if(F.col(DAY) >= day).alias("lines_in_batch"))

    def _read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def dated(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their id and their order's day, null if the order is unknown."""
    # an order key that comes twice must not double its lines
    days = orders.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.to_date(F.max("o_orderdate")).alias(DAY))
    return lines.select(*LINE_COLS).join(days.hint("merge"), "l_orderkey", "left") \
        .select(order_line_id().alias(KEY), DAY, *LINE_COLS)
