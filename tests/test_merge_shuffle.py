"""What a merge shuffles follows its batch, not its table."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, layout, marts, quality, upsert

KIND = "order_key string, order_date date, channel string, return_flag boolean, net_revenue int, gross_profit int, dw_loaded_at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)
DAY = dt.date(2020, 1, 5)


def make(spark, rows):
    return spark.createDataFrame([(k, d, "web", False, n, 0, T0) for k, d, n in rows], KIND)


def rows_of(df):
    return sorted(map(str, df.select(*[c.split()[0] for c in KIND.split(", ")]).collect()))


TARGET = [(f"k{i}", DAY + dt.timedelta(days=i), i) for i in range(60)] + [("twice", DAY, 1), ("twice", DAY, 2), (None, DAY, 3)]
BATCH = [("k3", DAY + dt.timedelta(days=40), 100), ("k4", DAY + dt.timedelta(days=4), 101), ("new", None, 102), ("twice", DAY, 9), (None, DAY, 7)]


def test_a_merge_arranges_only_what_the_batch_meets(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET[:60]), path)
    seen, real = [], layout.arrange
    monkeypatch.setattr(layout, "arrange", lambda df, *a: seen.append(df.count()) or real(df, *a))
    layout.merge_into(spark, path, make(spark, BATCH[:3]), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=T0))
    assert seen == [3]
    found = {r["order_key"]: r["net_revenue"] for r in spark.read.parquet(path).collect()}
    assert found == {f"k{i}": i for i in range(60)} | {"k3": 100, "k4": 101, "new": 102}


@pytest.mark.parametrize("filter_keys", [0, 4096])
@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_ways_of_a_merge_agree(spark, scratch, monkeypatch, filter_keys, max_bytes):
    """By the key filter or without it, rows apart or all joined, with keys twice and none."""
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET), path)
    real = joins.split_by_keys
    monkeypatch.setattr(layout, "FILTER_KEYS", filter_keys)
    monkeypatch.setattr(layout, "split_by_keys", lambda r, k, key: real(r, k, key, max_bytes))
    layout.merge_into(spark, path, make(spark, BATCH), lambda t, s: upsert.upsert(t, s, as_of=T0))
    expected = rows_of(upsert.upsert(make(spark, TARGET), make(spark, BATCH), as_of=T0))
    assert rows_of(layout.without_partition_col(spark.read.parquet(path))) == expected


def test_upsert_apart_is_upsert(spark):
    t, s = make(spark, TARGET), make(spark, BATCH)
    for cols in (upsert.MERGE_UPDATE_COLS, "all"):
        assert rows_of(upsert.upsert_apart(t, s, update_cols=cols, as_of=T0)) == rows_of(upsert.upsert(t, s, update_cols=cols, as_of=T0))
    kept, met = joins.split_by_keys(t, s.select("order_key"), "order_key")
    assert kept.count() == 58 and met.count() == 5


def test_a_copy_of_an_arranged_table_is_not_shuffled(spark, scratch):
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET), path)
    fact = layout.without_partition_col(spark.read.parquet(path))
    layout.write_layout(fact, f"{scratch}/copy", arranged=True)
    plan = layout.in_place(fact, "date_channel")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows_of(spark.read.parquet(f"{scratch}/copy")) == rows_of(make(spark, TARGET))


def test_key_filter_shuffles_places_not_bitmaps(spark):
    rows = layout.with_partition_col(make(spark, TARGET))
    plan = layout.key_filter(rows, layout.PARTITION_COL)._jdf.queryExecution().executedPlan().toString()
    above = [line for line in plan.splitlines() if re.search(r"Exchange|bitmap_construct_agg", line)]
    last = max(i for i, line in enumerate(above) if "bitmap_construct_agg" in line)
    assert "Exchange hashpartitioning" in above[last + 1]
    assert not any("Exchange hashpartitioning" in line for line in above[:last])


def test_packed_text_comes_back(spark):
    texts = ["d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "", "a", "é" * 8, "x" * 14, "x" * 15, "x" * 16, "x" * 17,
             "x" * 15 + "\x02", "x" * 14 + "\x01", "x" * 31, "x" * 32, "0" * 31, "0" * 32, "0" * 33, "missing", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", joins.packed("t").alias("p"))
    got = df.select("t", "p", joins.unpacked("p").alias("u")).collect()
    assert [r["u"] for r in got] == texts
    assert len({bytes(r["p"]) for r in got if r["p"] is not None}) == len(texts) - 1
    assert len(got[0]["p"]) == 16


def lines(spark, n=40):
    """A fact's keys and measures, some keys unknown or none."""
    ids = spark.range(n)
    def key(name, every, of):
        return F.when(F.col("id") % 13 == every, None).when(F.col("id") % 17 == every, "missing").otherwise(F.md5(F.concat(F.lit(name), (F.col("id") % of).cast("string"))))
    return ids.select(F.md5(F.col("id").cast("string")).alias("order_key"), key("p", 1, 7).alias("product_key"), key("g", 2, 3).alias("geo_key"),
                      (20200100 + F.col("id") % 5).cast("int").alias("date_key"), F.expr("date_add(date'2019-12-20', int(id))").alias("order_date"),
                      (F.col("id") % 4).cast("int").alias("quantity"), F.expr("cast(id as decimal(12,2)) / 1").cast("decimal(12,2)").alias("net_revenue"))


def dims(spark):
    p = spark.range(7).select(F.md5(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("product_key"),
                              (F.col("id") % 2).cast("string").alias("category"), (F.col("id") % 3).cast("string").alias("product_name"))
    g = spark.range(3).select(F.md5(F.concat(F.lit("g"), F.col("id").cast("string"))).alias("geo_key"), (F.col("id") % 2).cast("string").alias("region"))
    return p, g


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return [line for line in plan_of(df).splitlines() if "hashpartitioning(" in line]


def test_product_lines_are_shuffled_by_packed_key_and_by_result(spark, monkeypatch):
    f, (p, g) = lines(spark), dims(spark)
    expected = f.join(p, "product_key").join(g, "geo_key").groupBy(F.year("order_date").alias("year"), "region", "category", "product_name") \
        .agg(F.sum("net_revenue").cast("double").alias("n"), F.sum("quantity").alias("u"))
    got = marts.agg_product_performance(f, p, g)
    assert sorted(map(str, got.select(*got.columns[:4], F.col("net_revenue").cast("double").alias("n"), F.col("units_sold").alias("u")).collect())) \
        == sorted(map(str, expected.collect())) != []
    monkeypatch.setattr(marts, "checked_broadcast", lambda df, *a: F.broadcast(df) if "region" in df.columns else df.hint("merge"))
    of_lines = [s for s in shuffles(marts.agg_product_performance(f, p, g)) if "year" in s]
    assert len(of_lines) == 1 and "geo_key" not in of_lines[0]


def test_orphans_by_broadcast_and_by_counts(spark, monkeypatch):
    f, (p, g) = lines(spark), dims(spark)
    fks = {"product_key": (p, "product_key"), "geo_key": (g, "geo_key"), "date_key": (spark.range(20200101, 20200110), "id")}
    def found(df):
        return {r["foreign_key"]: r["orphans"] for r in df.collect()}
    small = quality.orphans_all_fks(f, fks)
    assert not shuffles(small)  # lines are not moved for dimensions that can be broadcast
    unknown = {fk: f.join(d.select(F.col(pk).cast("string").alias("_k")), F.col(fk).cast("string") == F.col("_k"), "left_anti").count()
               for fk, (d, pk) in fks.items()}
    assert found(small) == unknown and unknown["product_key"] > 3 and unknown["date_key"] == 8
    monkeypatch.setattr(quality, "BROADCAST_MAX_BYTES", -1)
    assert found(quality.orphans_all_fks(f, fks)) == unknown


def test_primary_key_check_shuffles_packed_keys(spark):
    f = lines(spark)
    df = quality.constraint_violations(f.unionByName(f.limit(3)), "t", ["order_key"], "order_key")
    assert {r["check_name"]: r["violations"] for r in df.collect()} == {"not_null": 0, "primary_key": 3}
    assert not any("(order_key" in s for s in shuffles(df))


def test_layouts_shuffle_packed_keys(spark):
    f = lines(spark).select("*", F.lit("web").alias("channel"), F.lit("7").alias("customer_id"))
    for name in ("customer", "date_channel", "day_customer_channel"):
        df = layout.arrange(f, name)
        plan = plan_of(df)
        below = plan[plan.index("Exchange rangepartitioning"):]
        assert "unhex(order_key" in below and "unhex(product_key" in below
        assert sorted(map(str, layout.without_partition_col(df).select(*f.columns).collect())) == sorted(map(str, f.collect()))


def test_deliveries_are_deduplicated_without_a_sort(spark):
    feed = spark.createDataFrame([("a", DAY), ("a", DAY + dt.timedelta(days=2)), ("b", None), (None, DAY)], "order_line_id string, delivered_date date")
    one = upsert.dedupe_source(feed, "order_line_id", order_by="delivered_date")
    assert sorted(map(str, one.collect())) == sorted(map(str, [*spark.createDataFrame(
        [("a", DAY + dt.timedelta(days=2)), ("b", None), (None, DAY)], "order_line_id string, delivered_date date").collect()]))
    assert "SortAggregate" not in plan_of(one)
