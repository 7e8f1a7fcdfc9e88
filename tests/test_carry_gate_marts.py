"""As-of join, gated loads, stored marts and the curve layout on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import gate, layout, upsert
from starloom.operators.asof import asof_join
from starloom.operators.pit import pit_join
from starloom.operators.stored_marts import StoredMarts

DAY0 = dt.datetime(2020, 1, 1)


def test_asof_join_equals_interval_join_with_many_versions_of_one_key(spark):
    rng = random.Random(2)
    versions = [("hot", f"v{i}", DAY0 + dt.timedelta(hours=i), DAY0 + dt.timedelta(hours=i + (i % 7 != 3))) for i in range(10_000)]
    versions += [("cold", "c1", DAY0, DAY0 + dt.timedelta(days=3)), ("gone", "g1", DAY0, DAY0 + dt.timedelta(days=1))]
    lines = [(i, rng.choice(["hot", "cold", "gone", "unknown", None]), DAY0 + dt.timedelta(minutes=30 * rng.randint(-50, 22_000))) for i in range(3000)]
    lines += [(3000, "hot", None), (3001, "hot", DAY0), (3001, "hot", DAY0)]
    v = spark.createDataFrame(versions, "customer_id string, customer_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    o = spark.createDataFrame(lines, "line int, customer_id string, order_date timestamp_ntz")
    got = asof_join(o, v, slices=7)
    assert got.columns == ["line", "customer_id", "order_date", "customer_key"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in line and "_t#" in line for line in plan.splitlines())  # no range residue
    assert sorted(map(str, got.collect())) == sorted(map(str, pit_join(o, v).select(*got.columns).collect()))


def test_asof_join_empty_sides(spark):
    v = spark.createDataFrame([], "customer_id string, customer_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    o = spark.createDataFrame([(1, "a", DAY0)], "line int, customer_id string, order_date timestamp_ntz")
    assert [r["customer_key"] for r in asof_join(o, v).collect()] == [None]
    assert asof_join(o.limit(0), v).count() == 0


FACT = ("order_key string, order_date date, channel string, customer_id string, order_id string, quantity int, gross_revenue decimal(12,2), "
        "net_revenue decimal(12,2), gross_profit decimal(12,2), return_flag boolean, dw_loaded_at timestamp_ntz")


def fact_rows(spark, n=60, shift=0):
    return spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("order_key"), F.expr(f"date'2020-01-15' + cast(id * 3 + {shift} as int)").alias("order_date"),
        F.element_at(F.array(F.lit("web"), F.lit("app")), (F.col("id") % 2 + 1).cast("int")).alias("channel"),
        (F.col("id") % 5).cast("string").alias("customer_id"), F.floor(F.col("id") / 3).cast("string").alias("order_id"),
        F.lit(1).alias("quantity"), F.lit(9).cast("decimal(12,2)").alias("gross_revenue"), (F.col("id") % 9).cast("decimal(12,2)").alias("net_revenue"),
        F.lit(1).cast("decimal(12,2)").alias("gross_profit"), (F.col("id") % 4 == 0).alias("return_flag"), F.lit(DAY0).cast("timestamp_ntz").alias("dw_loaded_at"))


def all_columns(t, s):
    return upsert.upsert(t, s, update_cols="all", as_of=DAY0)


def test_stored_marts_follow_merges_and_touch_their_months_only(spark, scratch):
    from starloom.operators import stored_marts as sm
    fact, root = f"{scratch}/fact", f"{scratch}/marts"
    layout.write_layout(fact_rows(spark), fact, "date_channel")
    kept = StoredMarts(spark, fact, root).build()
    files = {f for f in spark.read.parquet(f"{root}/daily_revenue").inputFiles()}
    kept.merge(fact_rows(spark, 60, 1).filter("order_key in ('k3', 'k4')"), all_columns)
    now = {f for f in spark.read.parquet(f"{root}/daily_revenue").inputFiles()}
    changed = {f.split("order_month=")[1][:10] for f in files ^ now}
    assert changed == {"2020-01-01"}
    whole = sm.order_days(spark.read.parquet(fact))
    for got, want in ((kept.daily(), sm.daily_revenue(whole)), (kept.cohort(), sm.cohort(whole)), (kept.channels(), sm.channel_performance(whole))):
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_stored_marts_after_a_refresh_that_was_broken_off(spark, scratch, monkeypatch):
    from starloom.operators import stored_marts as sm
    fact, root = f"{scratch}/fact", f"{scratch}/marts"
    layout.write_layout(fact_rows(spark), fact, "date_channel")
    kept = StoredMarts(spark, fact, root).build()
    monkeypatch.setattr(sm, "daily_revenue", lambda days: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.merge(fact_rows(spark, 60, 40).filter("order_key < 'k3'"), all_columns)
    monkeypatch.undo()
    assert kept.stale()
    kept.refresh()
    want = sm.daily_revenue(sm.order_days(spark.read.parquet(fact)))
    assert not kept.stale() and sorted(map(str, kept.daily().select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_refused_load_leaves_the_table_and_keeps_the_findings(spark, scratch):
    fact = f"{scratch}/fact"
    layout.write_layout(fact_rows(spark), fact, "date_channel")
    before = sorted(map(str, spark.read.parquet(fact).collect()))

    def audit(rows):
        return rows.agg(F.lit("negative").alias("check_name"), F.count_if(F.col("net_revenue") < 0).alias("failures")).filter("failures > 0")

    bad = fact_rows(spark).filter("order_key = 'k7'").withColumn("net_revenue", F.lit(-1).cast("decimal(12,2)"))
    with pytest.raises(gate.LoadRefused):
        gate.gated_merge(spark, fact, bad, all_columns, audit)
    assert sorted(map(str, spark.read.parquet(fact).collect())) == before
    assert [(r["check_name"], r["failures"]) for r in gate.refusals(spark, fact).collect()] == [("negative", 1)]
    good = fact_rows(spark).filter("order_key = 'k7'").withColumn("net_revenue", F.lit(8).cast("decimal(12,2)"))
    gate.gated_merge(spark, fact, good, all_columns, audit)
    assert spark.read.parquet(fact).filter("order_key = 'k7' and net_revenue = 8").count() == 1


def test_curve_prunes_in_every_column(spark, scratch):
    rows = spark.range(40_000).select(
        F.concat(F.lit("k"), "id").alias("order_key"), F.expr("date'2018-01-01' + cast(pmod(xxhash64(id), 1000) as int)").alias("order_date"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))).alias("channel"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(300)).cast("string").alias("customer_id"))
    path = f"{scratch}/curve"
    layout.write_layout(rows, path, "curve", files=64)
    t = spark.read.parquet(path).withColumn("f", F.input_file_name())
    files = t.select("f").distinct().count()
    def held(cond):
        return t.filter(cond).select("f").distinct().count() / files
    assert t.count() == 40_000
    assert held("customer_id = '17'") < 0.45 and held("channel = 'c1'") < 0.6 and held("order_date < date'2018-03-01'") < 0.6
    assert held("channel = 'c1' and order_date < date'2018-03-01'") < 0.3
