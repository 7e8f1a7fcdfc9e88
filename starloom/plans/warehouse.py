"""The warehouse over one raw-table folder: staging views and stored tables.

Staging is a set of lazy views. The delivered customer feed, dimensions, the
customer time line, the fact and the product pre-aggregate are stored tables, as in the modelled warehouse:
each is built once from the tables before it (staging -> dims -> fact ->
marts) and written as Parquet; every report, check and mart reads the stored
table. They live in the application's folder on shared storage, in a subfolder
named after the raw tables' state, so raw data that has changed gives a new
build and nothing is kept in the process.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import calendar, dims, facts, layout, marts, scd2
from starloom.operators.pit import customer_timeline
from starloom.params import DEFAULT_AS_OF
from starloom.session import application_path, ensure_checkpoint_dir, released_shuffles
from starloom.sources import staging
from starloom.sources.tables import RAW_TABLES, read_raw, table_path


def raw_state(spark: SparkSession, sf_dir: str) -> str:
    """A name for the present state of the raw tables: their paths, sizes,
    file counts and modification times."""
    parts = []
    for name in RAW_TABLES:
        path = table_path(sf_dir, name)
        fs, p, _ = layout._fs(spark, path)
        if fs.exists(p):
            summary = fs.getContentSummary(p)
            parts.append((path, summary.getLength(), summary.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


class Warehouse:
    """``root``: folder of the stored tables; by default one per application
    and state of the raw tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF, root: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        ensure_checkpoint_dir(spark)
        self.root = root or f"{application_path(spark)}/warehouse-{raw_state(spark, sf_dir)}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _stored(self, name: str, build, write=None) -> DataFrame:
        """The table ``name``, built and written unless its write was committed before."""
        path = self.path(name)
        if not layout.path_exists(self.spark, f"{path}/_SUCCESS"):
            with released_shuffles(self.spark):
                (write or self._write)(build(), path)
        return self.spark.read.parquet(path)

    @staticmethod
    def _write(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").option("compression", layout.CODEC).parquet(path)

    # --- staging ---------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.spark, self.sf_dir)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.spark, self.sf_dir)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.spark, self.sf_dir)

    @cached_property
    def src_geography(self) -> DataFrame:
        return staging.src_geography(self.spark, self.sf_dir)

    # --- core ------------------------------------------------------------
    @cached_property
    def customer_feed(self) -> DataFrame:
        """The change feed as delivered: ``stg_customers`` stored, for the merges that read it batch by batch."""
        return self._stored("customer_feed", lambda: self.stg_customers)

    @cached_property
    def snapshot(self) -> DataFrame:
        return self._stored("snap_customer", lambda: scd2.scd2_history(self.stg_customers))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._stored("dim_customer", lambda: scd2.dim_from_snapshot(self.snapshot, as_of=self.as_of))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._stored("dim_product", lambda: dims.dim_product(self.stg_products, as_of=self.as_of))

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self._stored("dim_geography", lambda: dims.dim_geography(self.src_geography))

    @cached_property
    def calendar_days(self) -> DataFrame:
        o = read_raw(self.spark, self.sf_dir, "orders", ["o_orderdate"])
        return calendar.days_spanning_years(o, "o_orderdate")

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar.dim_date(self.calendar_days)

    @cached_property
    def first_orders(self) -> DataFrame:
        """First order day per customer over order lines.

        Computed from the narrow (order key, customer, date) projection with
        a semi join against line keys, not from the wide staged lines, so the
        second pass over lines reads one column.
        """
        def build():
            o = read_raw(self.spark, self.sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
            # distinct line keys (map-side partial distinct): an order with a huge
            # number of lines is one row on the semi join's build side
            li = read_raw(self.spark, self.sf_dir, "lineitem", ["l_orderkey"]).distinct()
            with_lines = o.join(li, o.o_orderkey == li.l_orderkey, "left_semi")
            return with_lines.groupBy(F.col("o_custkey").cast("string").alias("customer_id")).agg(
                F.min(F.to_date("o_orderdate")).alias("first_order_date"))
        return self._stored("first_orders", build)

    @cached_property
    def timeline(self) -> DataFrame:
        """Customer versions and first order dates as one cover of the time line."""
        return self._stored("customer_timeline", lambda: customer_timeline(self.dim_customer, self.first_orders))

    def fact_for(self, orders: DataFrame, **kw) -> DataFrame:
        """Fact rows for staged lines (all, or an incremental slice)."""
        return facts.build_fact(orders, self.dim_customer, self.dim_product, self.dim_geography, None,
                                as_of=self.as_of, timeline=self.timeline, **kw)

    def load_fact(self, path: str, **days) -> None:
        """Write the fact of all lines, or of those that ``staging.stg_orders`` takes for ``days``."""
        rows = facts.narrow_rows(self.spark, self.sf_dir, self.dim_product, self.dim_geography, self.timeline, **days)
        layout.write_layout(rows, path, "date_channel", tiebreak=facts.NARROW_TIEBREAK,
                            finish=lambda df, keep: facts.finish(df, as_of=self.as_of, keep=keep))

    @cached_property
    def _fact_stored(self) -> DataFrame:
        path = self.path("fact_orders")
        if not layout.path_exists(self.spark, f"{path}/_SUCCESS"):
            with released_shuffles(self.spark):
                self.load_fact(path)
        return self.spark.read.parquet(path)

    @cached_property
    def fact(self) -> DataFrame:
        """The stored fact (month partitions, sorted by date and channel)."""
        return layout.without_partition_col(self._fact_stored)

    def fact_between(self, date_from=None, date_to=None) -> DataFrame:
        """The stored fact through the guarded reader: only the months of the range are read."""
        self._fact_stored  # noqa: B018  built if need be
        return layout.without_partition_col(layout.read_fact(self.spark, self.path("fact_orders"), date_from, date_to))

    @cached_property
    def fact_by_customer(self) -> DataFrame:
        """The copy of the fact that is clustered by customer."""
        return self._stored("fact_customer", lambda: self.fact, lambda df, path: layout.write_layout(df, path, "customer", stored=True))

    @cached_property
    def agg_product_performance(self) -> DataFrame:
        """The stored pre-aggregate, partitioned by year."""
        return self._stored("agg_product_performance",
                            lambda: marts.agg_product_performance(self.fact, self.dim_product, self.dim_geography),
                            lambda df, path: df.write.mode("overwrite").option("compression", layout.CODEC).partitionBy("year").parquet(path))
