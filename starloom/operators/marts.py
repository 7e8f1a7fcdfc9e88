"""Aggregation layer and the analytical queries asked of the model.

Star queries aggregate the fact by its foreign keys *before* joining the
dimensions (eager aggregation): the partial aggregate combines map-side, so
the joins see one row per (key, group) instead of one per order line, and a
hot key costs nothing extra. The dimension attributes are then re-grouped. Dimension sides are broadcast
behind a size check (``joins.checked_broadcast``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions.dates import month_start
from starloom.functions.money import TOTAL
from starloom.operators.joins import checked_broadcast, packed
from starloom.params import FORECAST_UPLIFT, TOP_K, UNKNOWN


def _between(df: DataFrame, date_from, date_to, col: str = "order_date") -> DataFrame:
    if date_from is not None:
        df = df.filter(F.col(col) >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        df = df.filter(F.col(col) <= F.lit(str(date_to)).cast("date"))
    return df


def money_sum(col: str, alias: str):
    return F.sum(col).cast(TOTAL).alias(alias)


# --- benchmark queries ------------------------------------------------------

def monthly_revenue(fact: DataFrame, date_from, date_to, channel: str | None = None) -> DataFrame:
    """Revenue by month and channel in a date window (optionally one channel)."""
    f = _between(fact, date_from, date_to)
    if channel is not None:
        f = f.filter(F.col("channel") == channel)
    return (
        f.groupBy(month_start("order_date").alias("month"), "channel")
        .agg(money_sum("net_revenue", "revenue"))
        .orderBy("month", "channel")
    )


def customer_history(fact: DataFrame, customer_id) -> DataFrame:
    """Every order line of one customer, oldest first."""
    return (
        fact.filter(F.col("customer_id") == F.lit(customer_id))
        .select("order_date", "order_id", "order_line_id", "net_revenue", "return_flag")
        .orderBy("order_date", "order_line_id")
    )


def top_products(fact: DataFrame, dim_product: DataFrame, dim_geography: DataFrame,
                 date_from=None, date_to=None, k: int = TOP_K) -> DataFrame:
    """Top ``k`` (region, category, product) by revenue; ties by the group keys."""
    f = _between(fact, date_from, date_to)
    pre = f.groupBy("product_key", "geo_key").agg(
        F.sum("net_revenue").alias("revenue"), F.sum("quantity").alias("units"))
    p = checked_broadcast(dim_product.select("product_key", "category", "product_name"))
    g = checked_broadcast(dim_geography.select("geo_key", "region"))
    j = pre.join(p, "product_key", "inner").join(g, "geo_key", "inner")
    out = j.groupBy("region", "category", "product_name").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"), F.sum("units").cast("long").alias("units"))
    return out.orderBy(F.desc("revenue"), "region", "category", "product_name").limit(k)


def agg_product_performance(fact: DataFrame, dim_product: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Pre-aggregate: (year, region, category, product_name) -> revenue, units.

    Few lines share a year, product and place, so the lines are not grouped by their keys
    first: they meet the products once, narrow and by packed keys, and are grouped by the result.
    """
    p = checked_broadcast(dim_product.select(packed("product_key").alias("product_key"), "category", "product_name"))
    g = checked_broadcast(dim_geography.select("geo_key", "region"))
    lines = fact.join(g, "geo_key", "inner").select(
        F.year("order_date").alias("year"), "region", packed("product_key").alias("product_key"), "net_revenue", "quantity")
    return lines.join(p, "product_key", "inner").groupBy("year", "region", "category", "product_name").agg(
        F.sum("net_revenue").cast(TOTAL).alias("net_revenue"),
        F.sum("quantity").cast("long").alias("units_sold"))


def top_products_from_agg(agg: DataFrame, year: int, k: int = TOP_K) -> DataFrame:
    """The same report served from the pre-aggregate."""
    out = agg.filter(F.col("year") == year).groupBy("region", "category", "product_name").agg(
        F.sum("net_revenue").cast(TOTAL).alias("revenue"), F.sum("units_sold").cast("long").alias("units"))
    return out.orderBy(F.desc("revenue"), "region", "category", "product_name").limit(k)


def full_range_sum(fact: DataFrame, date_from, date_to) -> DataFrame:
    """Sum of net revenue (and line count) over a date window."""
    f = _between(fact, date_from, date_to)
    return f.agg(money_sum("net_revenue", "revenue"), F.count(F.lit(1)).alias("order_lines"))


# --- aggregate tables -------------------------------------------------------

def agg_daily_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date", "channel").agg(
        F.countDistinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("quantity").cast("long").alias("units"),
        money_sum("gross_revenue", "gross_revenue"),
        money_sum("net_revenue", "net_revenue"),
        money_sum("gross_profit", "gross_profit"),
        F.sum(F.col("return_flag").cast("int")).cast("long").alias("returns"),
    )


def agg_cohort(fact: DataFrame) -> DataFrame:
    """Customers and revenue by first-order month and months since."""
    first = fact.groupBy("customer_id").agg(month_start(F.min("order_date")).alias("cohort_month"))
    per = fact.groupBy("customer_id", month_start("order_date").alias("order_month")).agg(
        F.sum("net_revenue").alias("net_revenue"))
    j = per.join(first, "customer_id", "inner")
    months = (F.year("order_month") - F.year("cohort_month")) * 12 + F.month("order_month") - F.month("cohort_month")
    return j.groupBy("cohort_month", months.cast("int").alias("months_since")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("net_revenue").cast(TOTAL).alias("net_revenue"))


def agg_channel_perf(fact: DataFrame) -> DataFrame:
    per = fact.groupBy("channel").agg(
        F.countDistinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("net_revenue").cast(TOTAL).alias("revenue"),
        F.sum(F.col("return_flag").cast("int")).cast("long").alias("returns"),
    )
    return per.select(
        "channel", "orders", "order_lines", "revenue", "returns",
        (F.col("returns").cast("double") / F.col("order_lines")).alias("return_rate"),
        (F.col("revenue").cast("double") / F.col("orders")).alias("avg_order_value"),
    )


# --- analytical questions ---------------------------------------------------

def segment_quarter_growth(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Revenue by quarter and segment at order time, with growth vs the
    previous quarter of the same segment; lines without a customer version
    are the segment ``UNKNOWN``."""
    pre = fact.groupBy("customer_key", F.trunc("order_date", "quarter").alias("quarter_start")).agg(
        F.sum("net_revenue").alias("revenue"))
    d = checked_broadcast(dim_customer.select("customer_key", "customer_segment"))
    j = pre.join(d, "customer_key", "left").withColumn("customer_segment", F.coalesce("customer_segment", F.lit(UNKNOWN)))
    per = j.groupBy("quarter_start", "customer_segment").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"))
    w = W.partitionBy("customer_segment").orderBy("quarter_start")
    prev = F.lag("revenue").over(w)
    return per.select(
        "quarter_start", "customer_segment", "revenue",
        prev.alias("prev_revenue"),
        (F.col("revenue") - prev).cast(TOTAL).alias("growth"),
    )


def return_rate_by_acquisition(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    pre = fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("return_flag").cast("int")).alias("returns"))
    d = checked_broadcast(dim_customer.select("customer_key", "acquisition_channel"))
    j = pre.join(d, "customer_key", "left").withColumn("acquisition_channel", F.coalesce("acquisition_channel", F.lit(UNKNOWN)))
    per = j.groupBy("acquisition_channel").agg(
        F.sum("lines").cast("long").alias("order_lines"), F.sum("returns").cast("long").alias("returns"))
    return per.withColumn("return_rate", F.col("returns").cast("double") / F.col("order_lines"))


def revenue_forecast(actual: DataFrame, uplift: str = FORECAST_UPLIFT) -> DataFrame:
    """Forecast per region and year: previous year's revenue x uplift."""
    w = W.partitionBy("region").orderBy("year")
    prev = F.lag("revenue").over(w)
    return actual.select("region", "year", F.round(prev * F.expr(f"{uplift}BD"), 2).cast(TOTAL).alias("forecast"))


def region_vs_forecast(fact: DataFrame, dim_geography: DataFrame, forecast: DataFrame | None = None) -> DataFrame:
    """Actual revenue per region and year against a forecast table
    (region, year, forecast); by default the uplift rule above."""
    pre = fact.groupBy("geo_key", F.year("order_date").alias("year")).agg(F.sum("net_revenue").alias("revenue"))
    g = checked_broadcast(dim_geography.select("geo_key", "region"))
    j = pre.join(g, "geo_key", "left").withColumn("region", F.coalesce("region", F.lit(UNKNOWN)))
    actual = j.groupBy("region", "year").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"))
    fc = forecast if forecast is not None else revenue_forecast(actual)
    j = actual.join(fc, ["region", "year"], "left")
    return j.select(
        "region", "year", "revenue", "forecast",
        (F.col("revenue") - F.col("forecast")).cast(TOTAL).alias("variance"),
        F.when(F.col("forecast").isNull(), F.lit(None).cast("string"))
        .when(F.col("revenue") < F.col("forecast"), "under").otherwise("on_or_above").alias("status"),
    )


def new_vs_returning(fact: DataFrame) -> DataFrame:
    return fact.groupBy("is_first_order").agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.countDistinct("order_id").alias("orders"),
        money_sum("net_revenue", "revenue"),
    )
