"""What a step holds on disk while it runs: shuffles go when an action ends, merges move files, large tables go in rounds."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, layout, quality, upsert
from starloom.operators.facts import build_fact
from starloom.plans import catalog
from starloom.session import released_shuffles
from starloom.sources import staging

KIND = "order_key string, order_date date, channel string, customer_id string, return_flag boolean, net_revenue int, gross_profit int, dw_loaded_at timestamp_ntz"
COLS = [c.split()[0] for c in KIND.split(", ")]
T0 = dt.datetime(2024, 1, 1)
DAY = dt.date(2020, 1, 5)


def make(spark, rows):
    return spark.createDataFrame([(k, d, "web", str(n % 7), False, n, 0, T0) for k, d, n in rows], KIND)


def rows_of(df):
    return sorted(map(str, df.select(*COLS).collect()))


TARGET = [(f"k{i}", DAY + dt.timedelta(days=i), i) for i in range(90)] + [("undated", None, 5)]
BATCH = [("k3", DAY + dt.timedelta(days=40), 100), ("k70", DAY, 101), ("new", None, 102), ("undated", DAY, 9)]


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle")}


def left_by(spark, run):
    """Shuffle files that are there after ``run`` and were not before."""
    before = shuffle_files(spark)
    run()
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_writes_and_merges_leave_no_shuffle_files(spark, scratch):
    path = f"{scratch}/t"
    assert not left_by(spark, lambda: layout.write_layout(make(spark, TARGET), path))
    assert not left_by(spark, lambda: layout.merge_into(spark, path, make(spark, BATCH), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=T0)))
    assert not layout.path_exists(spark, f"{path}/{layout.BATCH}")
    df = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    with released_shuffles(spark):
        assert df.collect() and df.collect()  # a plan that is run again makes its shuffles again


def test_a_merge_moves_the_files_it_has_written(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET), path)
    written, real = [], layout._write_partitions
    monkeypatch.setattr(layout, "_write_partitions", lambda rows, at, *a: written.append(at) or real(rows, at, *a))
    layout.merge_into(spark, path, make(spark, BATCH), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=T0))
    assert path not in written and f"{path}/{layout.REDO}/{layout.ROWS}" in written
    expected = upsert.upsert(make(spark, TARGET), make(spark, BATCH), update_cols="all", as_of=T0)
    assert rows_of(spark.read.parquet(path)) == rows_of(expected)
    assert f"order_month={layout.NULL_PARTITION}" in layout._partitions(spark, path)
    again = make(spark, [("new", DAY, 1)])  # the last undated row leaves, and its partition with it
    layout.merge_into(spark, path, again, lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=T0))
    assert f"order_month={layout.NULL_PARTITION}" not in layout._partitions(spark, path)


def test_key_filter_is_built_once_and_kept(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET), path)
    sizes, real = [], layout.key_filter
    monkeypatch.setattr(layout, "key_filter", lambda rows, *a: sizes.append(rows.count()) or real(rows, *a))
    for key in ("k1", "k2"):
        layout.merge_into(spark, path, make(spark, [(key, DAY, 8)]), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=T0))
    assert sizes[0] == len(TARGET) and max(sizes[1:]) < len(TARGET)
    assert spark.read.parquet(path).count() == len(TARGET)


@pytest.mark.parametrize("max_bytes", [0, 4096, 1 << 20])
def test_rows_are_split_by_hashes_or_bitmaps(spark, max_bytes):
    t = make(spark, TARGET + [(None, DAY, 3)] + [(f"more{i}", DAY, i) for i in range(3000)])
    keys = t.where("order_key like 'more%' and net_revenue < 1500").select("order_key").unionByName(make(spark, [*BATCH, (None, DAY, 7)]).select("order_key"))
    split = joins.split_by_keys(t, keys, "order_key", max_bytes)
    if max_bytes == 0:
        assert split is None
        return
    kept, met = split
    assert kept.columns == met.columns == t.columns
    assert rows_of(kept.unionByName(met)) == rows_of(t)
    assert kept.join(keys, "order_key", "left_semi").isEmpty() and kept.where("order_key is null").isEmpty()
    assert 1200 < kept.count() <= 3092 - 1503


@pytest.mark.parametrize("name", ["date_channel", "day_customer_channel", "customer", "curve", "none"])
def test_a_large_stored_table_is_arranged_in_rounds(spark, scratch, monkeypatch, name):
    monkeypatch.setattr(layout, "ROUND_ROWS", 30)
    sizes, real = [], layout.arrange
    monkeypatch.setattr(layout, "arrange", lambda df, *a: sizes.append(df.count()) or real(df, *a))
    path, rows = f"{scratch}/t", make(spark, TARGET)
    for _ in range(2):  # the second write takes the place of the first
        layout.write_layout(rows, path, name, stored=True)
    assert 4 <= len(sizes) <= 8 and sum(sizes) == 2 * len(TARGET)
    assert layout.path_exists(spark, f"{path}/_SUCCESS")
    assert rows_of(spark.read.parquet(path)) == rows_of(rows)


def test_recluster_takes_few_partitions_at_a_time(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    layout.write_layout(make(spark, TARGET), path)
    monkeypatch.setattr(layout, "RECLUSTER_PARTITIONS", 2)
    seen, real = [], layout.rewrite_partitions
    monkeypatch.setattr(layout, "rewrite_partitions", lambda s, rows, *a: seen.append(rows.select(layout.PARTITION_COL).distinct().count()) or real(s, rows, *a))
    months = [r[0] for r in spark.read.parquet(path).select(layout.PARTITION_COL).distinct().collect()]
    layout.recluster(spark, path, months)
    assert len(months) == 5 and seen == [2, 2, 1]
    assert rows_of(spark.read.parquet(path)) == rows_of(make(spark, TARGET))


def test_rows_lost_is_the_count_of_except_all(spark):
    a = spark.createDataFrame([("a-b", "c", 1), ("a", "b-c", 1), ("x", None, 2), ("x", None, 2), (None, "x", 2), ("1:a", "", None)], "p string, q string, n int")
    b = spark.createDataFrame([("a-b", "c", 1), ("x", None, 2), ("none", None, 2), ("1:a", None, None), ("none", None, 2)], "p string, q string, n int")
    for x, y in ((a, b), (b, a), (a, a), (a, a.limit(0))):
        assert quality.rows_lost(x, y).first()[0] == x.exceptAll(y).count()


def test_lines_of_some_days_are_found_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    tables = {"region": ("r_regionkey int, r_name string", [(0, "R")]), "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
              "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "C#1", 0, "A")]),
              "part": ("p_partkey long, p_retailprice double", [(1, 2.0), (1, 3.0)]),
              "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
                         [(k, 1, "O", dt.datetime(2000, 1, 1 + k)) for k in range(20)] + [(19, 1, "F", dt.datetime(2000, 1, 2)), (30, 1, "O", dt.datetime(2001, 1, 1)), (None, 1, "O", None)]),
              "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                           "l_returnflag string, l_shipdate timestamp_ntz",
                           [(k % 20, 1 + k % 2, 1, k, 1.0, 2.0, 0.0, "N", T0) for k in range(60)] + [(None, 1, 1, 1, 1.0, 2.0, 0.0, "N", T0)] * 2)}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = staging.stg_orders(spark, str(tmp_path))
    assert staging.days_of_lines(spark, str(tmp_path)).agg(F.max("order_date")).first()[0] == whole.agg(F.max("order_date")).first()[0] == dt.date(2000, 1, 20)
    split = []
    real = joins.split_by_keys
    monkeypatch.setattr(staging, "split_by_keys", lambda *a: split.append(real(*a)) or split[-1])
    some = staging.stg_orders(spark, str(tmp_path), since="2000-01-18")
    expected = whole.where("order_date >= '2000-01-18'")
    assert expected.count() > 5 and sorted(map(str, some.collect())) == sorted(map(str, expected.collect()))
    assert split[0][1].count() < 15  # of 62 lines


def test_places_and_products_are_found_before_the_customer(spark):
    """Lines meet the customer's versions by packed keys and without their place."""
    o = spark.createDataFrame([("1-1", "1", "c1", "p1", "a", "b", "c", T0, DAY), ("2-1", "2", "c2", None, None, "b", "c", T0, DAY)],
                              "order_line_id string, order_id string, customer_id string, product_id string, city string, state string, country string, "
                              "order_timestamp timestamp_ntz, order_date date")
    money = {c: F.lit(1).cast("decimal(12,2)") for c in ("unit_price", "discount_pct", "gross_revenue", "net_revenue", "shipping_cost")}
    o = o.withColumns(money | {"channel": F.lit("web"), "quantity": F.lit(1), "order_status": F.lit("O")})
    line = spark.createDataFrame([("c1", dt.datetime(1, 1, 1), dt.datetime(9999, 1, 1), "ab" * 16, DAY)],
                                 "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, customer_key string, first_order_date date")
    p = spark.createDataFrame([("p1", "cd" * 16)], "product_id string, product_key string").withColumn("cost_price", F.lit(1).cast("decimal(12,2)"))
    g = spark.createDataFrame([("a", "b", "c", "ef" * 16)], "city string, state string, country string, geo_key string")
    found = build_fact(o, None, p, g, None, as_of=T0, broadcast_max_bytes=-1, timeline=line)
    got = {r["order_id"]: (r["customer_key"], r["product_key"], r["geo_key"], r["is_first_order"]) for r in found.collect()}
    assert got == {"1": ("ab" * 16, "cd" * 16, "ef" * 16, True), "2": (None, None, None, None)}


def test_arrivals_are_worked_out_once(spark, scratch, monkeypatch):
    days = [dt.date(1997, 12, 31), dt.date(1998, 1, 1), dt.date(1999, 12, 31), dt.date(2000, 1, 1), dt.date(1995, 1, 1), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, order_date date").repartition(3)
    landing, seen = f"{scratch}/landing", []
    catalog._arrivals_moved(df, "order_date", landing, lambda: seen.append({r[0] for r in spark.read.parquet(landing).select("id").collect()}))
    so_far = []
    for part in catalog._arrivals(df, "order_date"):
        so_far.append({r[0] for r in part.collect()} | (so_far[-1] if so_far else set()))
    assert seen == so_far and seen[-1] == set(range(6))
