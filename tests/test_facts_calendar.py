"""Calendar, fact measures, first-order flag, keys, top-k ties."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions.dates import fiscal_quarter, fiscal_year
from starloom.operators import calendar, facts, marts
from starloom.operators.pit import pit_join

D = dt.date


def test_m21_day_of_week_conventions(spark):
    days = calendar.days_between(spark, "2023-01-01", "2023-01-02")
    cal = {r.full_date: r for r in calendar.dim_date(days).collect()}
    spine = {r.full_date: r for r in calendar.date_spine(days).collect()}
    assert (cal[D(2023, 1, 1)].day_of_week, cal[D(2023, 1, 2)].day_of_week) == (1, 2)
    assert (cal[D(2023, 1, 1)].is_weekend, cal[D(2023, 1, 2)].is_weekend) == (True, False)
    assert (spine[D(2023, 1, 1)].day_of_week, spine[D(2023, 1, 2)].day_of_week) == (0, 1)
    assert cal[D(2023, 1, 1)].date_key == 20230101
    assert cal[D(2023, 1, 1)].day_name == "Sunday" and cal[D(2023, 1, 1)].month_short == "Jan"
    assert cal[D(2023, 1, 1)].week_number == 52


def test_m22_m23_fiscal(spark):
    df = spark.createDataFrame([(D(2023, 9, 30),), (D(2023, 10, 1),)], "d date")
    r = df.select(fiscal_year("d").alias("fy"), fiscal_quarter("d").alias("fq"),
                  fiscal_year("d", 1).alias("fy1"), fiscal_quarter("d", 1).alias("fq1")).collect()
    assert [(x.fy, x.fq) for x in r] == [(2023, 4), (2024, 1)]
    assert [(x.fy1, x.fq1) for x in r] == [(2023, 3), (2023, 4)]


def test_m24_generator_3652_days(spark):
    days = calendar.days_from(spark, "2019-01-01", 3652)
    assert days.agg(F.max("d")).first()[0] == D(2028, 12, 30)
    assert days.count() == 3652


def test_holiday_seed(spark):
    days = calendar.days_between(spark, "2023-12-24", "2023-12-26")
    cal = calendar.dim_date(days, holidays=calendar.read_holiday_seed(spark))
    got = {r.full_date: (r.is_holiday, r.holiday_name) for r in cal.collect()}
    assert got[D(2023, 12, 25)] == (True, "Christmas Day")
    assert got[D(2023, 12, 24)] == (False, None)


def test_m26_measures(spark):
    df = spark.createDataFrame([(Decimal("200.00"), Decimal("10.00"), Decimal("180.00"), Decimal("50.00"), 2)],
                               "g decimal(12,2), p decimal(5,2), n decimal(12,2), c decimal(12,2), q int")
    r = df.select(facts.discount_amount(F.col("g"), F.col("p")).alias("d"),
                  facts.cost_of_goods(F.col("c"), F.col("q")).alias("cogs"),
                  facts.gross_profit(F.col("n"), F.col("c"), F.col("q")).alias("gp"),
                  facts.tax_amount(F.col("n")).alias("tax")).first()
    assert (r.d, r.cogs, r.gp, r.tax) == (Decimal("20.00"), Decimal("100.00"), Decimal("80.00"), Decimal("14.40"))


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_line_id string, order_id string, customer_id string, product_id string, "
                                       "city string, state string, country string, order_timestamp timestamp_ntz, "
                                       "order_date date, channel string, quantity int, unit_price decimal(12,2), "
                                       "discount_pct decimal(5,2), gross_revenue decimal(12,2), "
                                       "net_revenue decimal(12,2), shipping_cost decimal(8,2), order_status string")


def _dims(spark):
    dc = spark.createDataFrame([("k1", "c1", dt.datetime(2023, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59))],
                               "customer_key string, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    dp = spark.createDataFrame([("pk1", "p1", Decimal("1.00"))], "product_key string, product_id string, cost_price decimal(12,2)")
    dg = spark.createDataFrame([("g1", "A", "B", "C"), ("gnull", None, "B", "C")],
                               "geo_key string, city string, state string, country string")
    return dc, dp, dg


def test_m11_m12_m25_m30_fact(spark):
    t = dt.datetime(2023, 1, 2)
    rows = [
        ("l1", "o1", "c1", "p1", "A", "B", "C", t, t.date(), "web", 1, None, Decimal(0), Decimal(10), Decimal(10), None, "F"),
        ("l2", "o1", "c1", "p1", None, "B", "C", t, t.date(), "web", 1, None, Decimal(0), Decimal(10), Decimal(10), None, "F"),
        ("l3", "o2", "cX", "p1", "A", "B", "C", t, t.date(), "web", 1, None, Decimal(0), Decimal(10), Decimal(10), None, "returned"),
    ]
    o = _orders(spark, rows)
    dc, dp, dg = _dims(spark)
    f = facts.build_fact(o, dc, dp, dg, facts.first_orders(o), as_of=dt.datetime(2024, 1, 1))
    got = {r.order_line_id: r for r in f.collect()}
    assert len(got) == 3 and len({r.order_key for r in got.values()}) == 3  # M12
    assert got["l3"].customer_key is None  # M11
    assert got["l1"].is_first_order and got["l2"].is_first_order  # M25
    assert got["l1"].geo_key == "g1" and got["l2"].geo_key is None  # M30
    assert got["l3"].return_flag is True
    from starloom.operators import quality
    assert quality.orphaned_orders(f).first()[0] == 1


def test_m27_topk_ties(spark):
    rows = [(f"pk{i}", "g", Decimal(100 if i < 25 else 1), 1) for i in range(30)]
    fact = spark.createDataFrame(rows, "product_key string, geo_key string, net_revenue decimal(12,2), quantity int")
    fact = fact.withColumn("order_date", F.lit("2023-05-01").cast("date"))
    dp = spark.createDataFrame([(f"pk{i}", "cat", f"name{i:02d}") for i in range(30)],
                               "product_key string, category string, product_name string")
    dg = spark.createDataFrame([("g", "R")], "geo_key string, region string")
    out = marts.top_products(fact, dp, dg, k=20).collect()
    assert [r.product_name for r in out] == [f"name{i:02d}" for i in range(20)]


def test_pit_join_plan_is_equi_join(spark):
    o = spark.createDataFrame([("c1", D(2023, 1, 1))], "customer_id string, order_date date")
    dc, _, _ = _dims(spark)
    plan = pit_join(o, dc)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_timeline_cover_and_shuffle_path(spark):
    from starloom.operators.pit import customer_timeline
    T = dt.datetime
    dim = spark.createDataFrame(
        [("k1", "c1", T(2023, 1, 1), T(2023, 2, 1)), ("k2", "c1", T(2023, 3, 1), T(9999, 12, 31, 23, 59, 59))],
        "customer_key string, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    fo = spark.createDataFrame([("c1", D(2022, 12, 1)), ("c2", D(2023, 1, 5))], "customer_id string, first_order_date date")
    cover = customer_timeline(dim, fo)
    orders = spark.createDataFrame([("a", "c1", D(2022, 12, 1)), ("b", "c1", D(2023, 1, 15)), ("c", "c1", D(2023, 2, 15)),
                                    ("d", "c1", D(2023, 4, 1)), ("e", "c2", D(2023, 1, 5))],
                                   "id string, customer_id string, order_date date")
    got = {r.id: (r.customer_key, r.first_order_date) for r in
           pit_join(orders, cover, take=("customer_key", "first_order_date")).collect()}
    assert got == {"a": (None, D(2022, 12, 1)), "b": ("k1", D(2022, 12, 1)), "c": (None, D(2022, 12, 1)),
                   "d": ("k2", D(2022, 12, 1)), "e": (None, D(2023, 1, 5))}


def test_fact_shuffle_path_single_customer_join(spark):
    from starloom.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    small = facts.build_fact(w.stg_orders, w.dim_customer, w.dim_product, w.dim_geography, w.first_orders)
    big = facts.build_fact(w.stg_orders, w.dim_customer, w.dim_product, w.dim_geography, w.first_orders,
                           broadcast_max_bytes=0)
    plan = big._jdf.queryExecution().executedPlan().toString()
    # one shuffle join carries both the version and the first-order date
    pit = [ln for ln in plan.splitlines() if "Join" in ln and "_pit_key" in ln]
    assert len(pit) == 1 and "SortMergeJoin" in pit[0]
    assert "first_order_date" not in plan.split("_pit_key")[0].split("SortMergeJoin")[-1]
    cols = [c for c in small.columns if c != "dw_loaded_at"]
    assert small.select(cols).exceptAll(big.select(cols)).count() == 0
    assert small.count() == big.count()
