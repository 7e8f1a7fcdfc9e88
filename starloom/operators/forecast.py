"""Seasonal revenue forecast: additive exponential smoothing with a trend and a
season of twelve months, per region.

The fact is reduced to a row per region and month by a grouping with map-side
combine; the recurrence then folds a region's months in a native aggregate
expression, so a group holds at most the months of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import checked_broadcast
from starloom.params import SMOOTHING, UNKNOWN

SEASON = 12


def monthly_revenue(fact: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """region, month, revenue; the fact is grouped by key and month before the join."""
    pre = fact.groupBy("geo_key", F.trunc("order_date", "month").alias("month")).agg(F.sum("net_revenue").alias("revenue"))
    g = checked_broadcast(dim_geography.select("geo_key", "region"))
    return pre.join(g, "geo_key", "left").where(F.col("month").isNotNull()) \
        .groupBy(F.coalesce("region", F.lit(UNKNOWN)).alias("region"), "month") \
        .agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue"))


def seasonal_forecast(monthly: DataFrame, ahead: int = SEASON, weights: tuple = SMOOTHING) -> DataFrame:
    """region, month, revenue, forecast: each month from the thirteenth on as seen
    the month before, and ``ahead`` months after the last one (revenue null).

    Defined results: a month without a row between a region's first and last one
    counts as zero; null revenue counts as zero; a region of fewer than twelve
    months has no forecast and returns its months with a null one; several rows of
    one month are summed; an empty table gives an empty one.
    """
    alpha, beta, gamma = (F.lit(float(w)) for w in weights)
    given = monthly.groupBy("region", F.trunc("month", "month").alias("month")) \
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(28,2)").alias("revenue"))
    span = given.groupBy("region").agg(F.min("month").alias("first"), F.max("month").alias("last"),
                                       F.map_from_entries(F.collect_list(F.struct("month", "revenue"))).alias("known"))
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    zero = F.lit(0).cast("decimal(28,2)")
    series = span.select("region", "first", F.transform(months, lambda m: F.coalesce(F.element_at("known", m), zero)).alias("y"))
    opening = F.slice("y", 1, SEASON)
    # the sum of the first season is exact; only then does it become a double
    level = F.aggregate(opening, zero, lambda s, v: (s + v).cast("decimal(28,2)")).cast("double") / SEASON
    series = series.withColumn("level", level).withColumn("n", F.size("y"))
    start = F.struct(F.col("level").alias("level"), F.lit(0.0).alias("trend"),
                     F.transform(opening, lambda v: v.cast("double") - F.col("level")).alias("season"),
                     F.array().cast("array<double>").alias("out"))

    def step(s: Column, v: Column) -> Column:
        """The head of ``season`` is the month's own; it moves to the end, renewed."""
        y, head = v.cast("double"), F.get(s["season"], F.lit(0))
        grown = s["level"] + s["trend"]
        level = alpha * (y - head) + (F.lit(1.0) - alpha) * grown
        return F.struct(
            level.alias("level"), (beta * (level - s["level"]) + (F.lit(1.0) - beta) * s["trend"]).alias("trend"),
            F.concat(F.slice(s["season"], 2, SEASON - 1), F.array(gamma * (y - level) + (F.lit(1.0) - gamma) * head)).alias("season"),
            F.concat(s["out"], F.array(grown + head)).alias("out"))

    whole = F.col("n") >= SEASON
    later = F.slice("y", SEASON + 1, F.greatest(F.col("n") - SEASON, F.lit(0)))
    folded = series.withColumn("s", F.when(whole, F.aggregate(later, start, step)))
    coming = F.transform(F.sequence(F.lit(1), F.lit(ahead)),
                         lambda k: F.col("s.level") + k * F.col("s.trend") + F.get(F.col("s.season"), (k - 1) % SEASON)) \
        if ahead else F.array().cast("array<double>")
    blank = F.array_repeat(F.lit(None).cast("double"), SEASON)
    values = F.when(whole, F.concat(blank, F.col("s.out"), coming)).otherwise(F.array_repeat(F.lit(None).cast("double"), F.col("n")))
    return folded.select("region", "first", "y", F.posexplode(values).alias("i", "forecast")) \
        .select("region", F.add_months("first", F.col("i")).alias("month"), F.get("y", F.col("i")).alias("revenue"), "forecast")


def region_forecast_gap(forecast: DataFrame) -> DataFrame:
    """Regions by year against the sum of their monthly forecasts, over months that have both."""
    both = forecast.where(F.col("revenue").isNotNull() & F.col("forecast").isNotNull())
    # cents, so that the order of adding up does not show
    cents = F.round(F.col("forecast") * 100).cast("decimal(28,0)")
    per = both.groupBy("region", F.year("month").alias("year")).agg(
        F.count(F.lit(1)).alias("months"), F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        (F.sum(cents) / 100).cast("decimal(28,2)").alias("forecast"))
    return per.withColumn("status", F.when(F.col("revenue") < F.col("forecast"), "under").otherwise("on_or_above"))
