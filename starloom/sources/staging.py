"""Staging layer: 1:1 views over the raw tables with light cleansing.

Money is cast to decimal before any arithmetic, so every downstream measure
is exact. Everything here is lazy; nothing is materialised.

Shuffle plan for ``stg_orders`` (the only large staging view): customers
are enriched with geography first (customer x nation x region: the two
reference tables are tiny and broadcast by size statistics), then orders
pick up the customer columns; order lines pick up the product price and the
order columns (``raw_lines``). Each join shuffles on its own key; AQE splits a
hot key (an order or a customer owning a large share of lines) at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions.money import MONEY, PCT, SMALL_MONEY, dec, round_money
from starloom.operators.joins import split_by_keys
from starloom.params import (
    CHANNELS, COST_RATIO, MARGIN_PCT, SEGMENT_BOUNDS, SEGMENT_TOP, SHIPPING_BASE,
    SHIPPING_PER_UNIT,
)
from starloom.sources.tables import read_raw


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
PLACE = ["city", "state", "country"]


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (city, state, country, region) by the staging mapping."""
    c = read_raw(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_raw(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_raw(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return (
        c.join(nr, c.c_nationkey == nr.n_nationkey, "left")
        .select(
            "c_custkey", "c_name", "c_mktsegment",
            F.concat(F.col("n_name"), F.lit("_C"), (F.col("c_custkey") % 4).cast("string")).alias("city"),
            F.concat(F.col("n_name"), F.lit("_S"), (F.col("c_custkey") % 2).cast("string")).alias("state"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )


def channel_of(order_key) -> "F.Column":
    names = F.array(*[F.lit(c) for c in CHANNELS])
    return F.element_at(names, (F.col(order_key) % len(CHANNELS) + 1).cast("int"))


def order_line_id() -> "F.Column":
    """Unique line id: (order, line number, part, supplier, ship day)."""
    return F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.date_format(F.col("l_shipdate"), "yyyyMMdd"),
    )


def raw_lines(spark: SparkSession, sf_dir: str, since=None, until=None, lines: DataFrame | None = None,
              of_order=None, of_product=None, of_customer=None) -> DataFrame:
    """Raw order lines with the columns of their product and order and the customer's place.

    ``of_order``, ``of_product`` and ``of_customer`` add what is looked up per order (from
    ``customer_id`` and ``order_date``), per product (from ``product_id``) and per customer
    (from city, state and country), before the lines meet them: so a lookup too large to
    broadcast shuffles orders or products and not the lines, of which there are many more.
    """
    li = read_raw(spark, sf_dir, "lineitem", LINE_COLS) if lines is None else lines.select(*LINE_COLS)
    o = read_raw(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(str(since)).cast("timestamp_ntz"))
    if until is not None:
        o = o.filter(F.col("o_orderdate") < F.date_add(F.lit(str(until)).cast("date"), 1).cast("timestamp_ntz"))
    if since is not None and lines is None:  # all lines, of which those of some days are few: they alone are shuffled
        split = split_by_keys(li, o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
        li = li if split is None else split[1]
    cg = customer_geo(spark, sf_dir).select("c_custkey", "city", "state", "country")
    p = read_raw(spark, sf_dir, "part", ["p_partkey", "p_retailprice"]) \
        .withColumn("p_retailprice", F.col("p_retailprice").cast(MONEY))
    # cents and days take fewer bytes in a shuffle; a line needs no more of its ship time than the day
    li = li.withColumns({"l_shipdate": F.to_date("l_shipdate"), "l_extendedprice": F.col("l_extendedprice").cast(MONEY)})

    if of_customer is not None:
        cg = of_customer(cg)
    oc = o.join(cg, o.o_custkey == cg.c_custkey, "left").drop("c_custkey")
    if of_order is not None:
        oc = of_order(oc.withColumns({"customer_id": F.col("o_custkey").cast("string"), "order_date": F.to_date("o_orderdate")}))
    if of_product is not None:
        p = of_product(p.withColumn("product_id", F.col("p_partkey").cast("string")))
    # lines x orders is a fact-to-fact join: always a shuffle (sort-merge)
    # join on the order key, never a broadcast of either side, whatever the
    # size estimate says; the shuffle also spreads the per-line work below
    # over all tasks when an input file is a single row group.
    def with_order(x: DataFrame) -> DataFrame:
        return x.join(oc.hint("merge"), F.col("l_orderkey") == oc.o_orderkey, "inner")

    def with_product(x: DataFrame) -> DataFrame:
        return x.join(p, F.col("l_partkey") == p.p_partkey, "left")

    # all lines meet their products while they are narrow; those of some days, once they are few
    return with_order(with_product(li)) if since is None else with_product(with_order(li))


def staged_columns() -> dict:
    """The staged columns over ``raw_lines``."""
    gross = F.col("l_extendedprice").cast(MONEY)
    disc = F.col("l_discount").cast("decimal(3,2)")
    qty = F.col("l_quantity").cast("int")
    return {
        "order_line_id": order_line_id(),
        "order_id": F.col("l_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        **{c: F.col(c) for c in PLACE},
        "order_timestamp": F.col("o_orderdate"),
        "order_date": F.to_date("o_orderdate"),
        "channel": channel_of("l_orderkey"),
        "quantity": qty,
        "unit_price": F.col("p_retailprice"),
        "discount_pct": F.round(F.col("l_discount") * 100).cast(PCT),
        "gross_revenue": gross,
        "net_revenue": round_money(gross * (F.lit(1) - disc)),
        "shipping_cost": (dec(SHIPPING_BASE) + dec(SHIPPING_PER_UNIT) * qty).cast(SMALL_MONEY),
        "order_status": F.when(F.col("l_returnflag") == "R", F.lit("returned"))
        .otherwise(F.col("o_orderstatus")),
    }


def stg_orders(spark: SparkSession, sf_dir: str, with_ship_date: bool = False, since=None, until=None,
               lines: DataFrame | None = None) -> DataFrame:
    """One row per order line in the shape the fact load reads, optionally of
    order days from ``since`` to ``until`` (literals, pushed to the scan).
    ``lines`` are the raw lines to take, by default all (``LineStore.between``
    gives those of the days)."""
    cols = [c.alias(name) for name, c in staged_columns().items()]
    if with_ship_date:
        cols.append(F.to_date("l_shipdate").alias("ship_date"))
    return raw_lines(spark, sf_dir, since, until, lines).select(*cols)


def days_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order days of ``stg_orders``: a row per order that has lines."""
    o = read_raw(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    li = read_raw(spark, sf_dir, "lineitem", ["l_orderkey"]).distinct()
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_semi").select(F.to_date("o_orderdate").alias("order_date"))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_raw(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    lp = F.col("p_retailprice").cast(MONEY)
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        round_money(lp * dec(COST_RATIO)).alias("cost_price"),
        lp.alias("list_price"),
        dec(MARGIN_PCT).cast(PCT).alias("margin_pct"),
        F.col("p_size").cast(SMALL_MONEY).alias("weight_kg"),
        F.lit(True).alias("is_active"),
        F.lit(None).cast("date").alias("launch_date"),
    )


def src_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (city, state, country) of the mapping with its region.

    Deduplicated on the three join columns so the fact join cannot fan out.
    The result is bounded by nations x 4 cities.
    """
    g = customer_geo(spark, sf_dir)
    return (
        g.groupBy("city", "state", "country")
        .agg(F.min("region").alias("region"))
        .select(
            "city", "state", "country", "region",
            F.lit(None).cast("string").alias("sub_region"),
            F.lit("UTC").alias("timezone"),
            F.lit(None).cast("double").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
        )
    )


def segment_of(spend) -> "F.Column":
    expr = None
    for bound, name in SEGMENT_BOUNDS:
        cond = spend < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEGMENT_TOP))


def customer_daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, order day, amount). The group-by combines map-side, so a
    customer with a huge order count shrinks to one row per day before the
    shuffle; later per-customer windows see at most one row per calendar day."""
    o = read_raw(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    return (
        o.groupBy(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("day"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("amt"))
    )


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change feed: one row per customer per day its segment changes.

    Running spend per customer by day decides the segment; a row is emitted
    on the first order day and whenever the segment differs from the day
    before. ``updated_at`` is that day at midnight.
    """
    daily = customer_daily_spend(spark, sf_dir)
    w = W.partitionBy("custkey").orderBy("day")
    running = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (
        daily.withColumn("spend", F.sum("amt").over(running))
        .withColumn("first_day", F.min("day").over(whole))
        .withColumn("segment", segment_of(F.col("spend")))
        .withColumn("prev_segment", F.lag("segment").over(w))
        .filter(F.col("prev_segment").isNull() | (F.col("prev_segment") != F.col("segment")))
    )
    cg = customer_geo(spark, sf_dir)
    # an order's customer that is not in the customer table keeps its changes, without attributes
    j = s.join(cg, s.custkey == cg.c_custkey, "left")
    return j.select(
        F.col("custkey").cast("string").alias("customer_id"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("full_name"),
        F.lit("Customer").alias("first_name"),
        F.substring_index(F.col("c_name"), "#", -1).alias("last_name"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.col("first_day").alias("acquisition_date"),
        F.col("segment").alias("customer_segment"),
        F.col("spend").cast(MONEY).alias("lifetime_value"),
        "city", "state", "country",
        F.lit(True).alias("is_active"),
        F.col("day").cast("timestamp_ntz").alias("updated_at"),
    )


def lines_without_order(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order keys of lines that no order explains, with their lines: the rows
    that ``stg_orders`` cannot stage."""
    counts = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("order_lines"))
    return counts.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")


def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as staged rows: one row per event id (the latest), trimmed
    lower-case type, blank properties as NULL."""
    e = read_raw(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    latest = e.groupBy("event_id").agg(F.max(F.struct("ts", "user_id", "event_type", "value", "props")).alias("r"))
    return latest.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("r.ts").alias("event_timestamp"),
        F.to_date("r.ts").alias("event_date"),
        F.col("r.user_id").cast("string").alias("user_id"),
        F.lower(F.trim("r.event_type")).alias("event_type"),
        F.col("r.value").cast(MONEY).alias("event_value"),
        F.nullif(F.trim("r.props"), F.lit("")).alias("properties"),
    )


def fulfilment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order line, the delivered date (date of the ship timestamp)."""
    li = read_raw(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return li.select(order_line_id().alias("order_line_id"), F.to_date("l_shipdate").alias("delivered_date"))


def job_log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job log in the shape the workload report reads, mapped from the
    events table: one job per event; reads (view, click, purchase) are
    QUERY jobs, signups LOAD jobs, errors EXTRACT jobs; the event value sets
    bytes (x 10^7) and slot milliseconds (x 1000); a job runs
    ``user_id % 60`` seconds from its event time."""
    e = read_raw(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.select(
        F.concat(F.lit("job_"), F.col("event_id").cast("string")).alias("job_id"),
        F.upper("event_type").alias("statement_type"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "QUERY")
        .when(F.col("event_type") == "signup", "LOAD").otherwise("EXTRACT").alias("job_type"),
        F.round(F.col("value") * 1e7).cast("long").alias("total_bytes_processed"),
        F.round(F.col("value") * 1000).cast("long").alias("total_slot_ms"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=(F.col("user_id") % 60).cast("int"))).alias("end_time"),
        F.col("ts").alias("creation_time"),
        F.col("props").alias("query"),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Raw orders cleansed: one row per order key (the latest date; ties by the
    remaining columns, largest first), text trimmed, status and priority in upper
    case, blanks as NULL. Rows without a key are one group and give one row. The
    grouping combines map-side and keeps one struct per key, so an order repeated
    without end is one row a task before the shuffle."""
    tidy = raw.select(
        "o_orderkey", "o_orderdate", "o_custkey", F.nullif(F.upper(F.trim("o_orderstatus")), F.lit("")).alias("o_orderstatus"),
        "o_totalprice", F.nullif(F.upper(F.trim("o_orderpriority")), F.lit("")).alias("o_orderpriority"))
    latest = tidy.groupBy("o_orderkey").agg(F.max(F.struct(
        "o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")).alias("r"))
    return latest.select("o_orderkey", "r.*")


def clean_customers(raw: DataFrame) -> DataFrame:
    """Raw customers cleansed: one row per customer key (largest of name, segment,
    nation, balance after trimming), segment in upper case, blanks as NULL."""
    tidy = raw.select(
        "c_custkey", F.nullif(F.trim("c_name"), F.lit("")).alias("c_name"),
        F.nullif(F.upper(F.trim("c_mktsegment")), F.lit("")).alias("c_mktsegment"), "c_nationkey", "c_acctbal")
    one = tidy.groupBy("c_custkey").agg(F.max(F.struct("c_name", "c_mktsegment", "c_nationkey", "c_acctbal")).alias("r"))
    return one.select("c_custkey", "r.*")


def customers_without_order(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers that the change feed, which starts at a first order, does not know."""
    # an order-rich customer is one row a task on the build side
    buyers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return customers.join(buyers, "c_custkey", "left_anti") \
        .select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("full_name"))
