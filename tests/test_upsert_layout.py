"""Incremental selection, upsert, write paths, layout analytics."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout, ops, upsert

D = dt.date


def _t(spark, rows):
    return spark.createDataFrame(rows, "order_key string, order_date date, return_flag boolean, "
                                       "net_revenue decimal(12,2), gross_profit decimal(12,2), "
                                       "tax_amount decimal(8,2), dw_loaded_at timestamp_ntz")


def test_m13_empty_target_full_load(spark):
    src = spark.createDataFrame([(D(2023, 1, 1),), (D(2023, 1, 9),)], "order_date date")
    empty = src.filter(F.lit(False))
    assert upsert.select_incremental(src, empty).count() == 2
    assert upsert.select_incremental(src, None).count() == 2


def test_m14_lookback_inclusive(spark):
    tgt = spark.createDataFrame([(D(2023, 1, 10),)], "order_date date")
    src = spark.createDataFrame([(D(2023, 1, 6),), (D(2023, 1, 7),), (D(2023, 1, 11),)], "order_date date")
    got = sorted(r.order_date for r in upsert.select_incremental(src, tgt, 3).collect())
    assert got == [D(2023, 1, 7), D(2023, 1, 11)]


def test_m15_update_four_columns(spark):
    old = dt.datetime(2023, 1, 1)
    t = _t(spark, [("k", D(2023, 1, 1), False, Decimal("10.00"), Decimal("5.00"), Decimal("0.80"), old)])
    s = _t(spark, [("k", D(2023, 1, 1), True, Decimal("10.00"), Decimal("4.00"), Decimal("9.99"), old)])
    now = dt.datetime(2024, 1, 1)
    r = upsert.upsert(t, s, as_of=now).first()
    assert (r.return_flag, r.gross_profit, r.tax_amount, r.dw_loaded_at) == (True, Decimal("4.00"), Decimal("0.80"), now)


def test_m16_null_never_differs_unless_null_safe(spark):
    t = _t(spark, [("k", D(2023, 1, 1), None, Decimal("10.00"), None, None, None)])
    s = _t(spark, [("k", D(2023, 1, 1), True, Decimal("10.00"), None, None, None)])
    assert upsert.upsert(t, s).first().return_flag is None
    assert upsert.upsert(t, s, null_safe=True).first().return_flag is True


def test_insert_and_keep(spark):
    t = _t(spark, [("a", D(2023, 1, 1), False, Decimal("1.00"), None, None, None)])
    s = _t(spark, [("b", D(2023, 1, 2), False, Decimal("2.00"), None, None, None)])
    assert sorted(r.order_key for r in upsert.upsert(t, s).collect()) == ["a", "b"]


def test_m31_duplicate_source_keys(spark):
    t = _t(spark, [("a", D(2023, 1, 1), False, Decimal("1.00"), None, None, None)])
    s = spark.createDataFrame(
        [("a", D(2023, 1, 1), True, Decimal("1.00"), None, None, dt.datetime(2023, 1, 1)),
         ("a", D(2023, 1, 1), False, Decimal("2.00"), None, None, dt.datetime(2023, 1, 2))],
        "order_key string, order_date date, return_flag boolean, net_revenue decimal(12,2), "
        "gross_profit decimal(12,2), tax_amount decimal(8,2), dw_loaded_at timestamp_ntz")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.upsert(t, s)
    r = upsert.upsert(t, s, order_by="dw_loaded_at").first()
    assert r.net_revenue == Decimal("2.00")


def _fact(spark, n=200):
    rows = [(f"k{i}", f"L{i}", f"c{i % 7}", D(2023, 1 + i % 12, 1 + i % 28), ["web", "app"][i % 2],
             Decimal(i)) for i in range(n)]
    return spark.createDataFrame(rows, "order_key string, order_line_id string, customer_id string, "
                                       "order_date date, channel string, net_revenue decimal(12,2)")


def test_guarded_reader_raises_and_prunes(spark, scratch):
    p = os.path.join(scratch, "f")
    layout.write_layout(_fact(spark), p, "date_channel", files=4)
    with pytest.raises(layout.PartitionFilterRequired):
        layout.read_fact(spark, p)
    df = layout.read_fact(spark, p, "2023-03-01", "2023-03-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert df.count() == _fact(spark).filter(F.month("order_date") == 3).count()


def test_merge_into_touches_only_source_months(spark, scratch):
    p = os.path.join(scratch, "f")
    base = _fact(spark).withColumn("return_flag", F.lit(False)).withColumn("gross_profit", F.col("net_revenue")) \
        .withColumn("dw_loaded_at", F.lit(None).cast("timestamp_ntz"))
    layout.write_layout(base, p, "date_channel", files=4)
    before = {r.order_key: r for r in spark.read.parquet(p).collect()}
    src = base.filter(F.col("order_key").isin("k2", "k14")).withColumn("return_flag", F.lit(True))
    layout.merge_into(spark, p, src, lambda t, s: upsert.upsert(t, s, as_of=dt.datetime(2024, 1, 1)))
    after = {r.order_key: r for r in spark.read.parquet(p).collect()}
    assert len(after) == len(before)
    assert after["k2"].return_flag and after["k14"].return_flag
    assert sum(1 for k in after if after[k].return_flag) == 2


def test_versioned_write(spark, scratch):
    base = os.path.join(scratch, "dim")
    assert layout.current_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        layout.read_versioned(spark, base)
    layout.write_versioned(spark, spark.range(3), base)
    layout.write_versioned(spark, spark.range(5), base)
    assert layout.read_versioned(spark, base).count() == 5


def test_version_left_behind_by_a_crash_is_ignored_and_overwritten(spark, scratch):
    base = os.path.join(scratch, "dim")
    layout.write_versioned(spark, spark.range(3), base)
    layout.write_versioned(spark, spark.range(5), base)
    os.remove(os.path.join(base, "v=2", "_SUCCESS"))  # the write did not get to its commit
    assert layout.read_versioned(spark, base).count() == 3
    layout.write_versioned(spark, layout.read_versioned(spark, base).limit(2), base)
    assert layout.read_versioned(spark, base).count() == 2 and layout.current_version(spark, base) == 2


def _merge_all(t, s):
    return upsert.upsert(t, s, update_cols="all", as_of=dt.datetime(2024, 1, 1), loaded_col=None)


def test_merge_keeps_undated_rows(spark, scratch):
    p = os.path.join(scratch, "f")
    kind = "order_key string, order_date date, channel string, qty int"
    rows = spark.createDataFrame([("a", D(2023, 1, 5), "web", 1), ("n1", None, "web", 1), ("n2", None, "app", 1)], kind)
    layout.write_layout(rows, p)
    layout.merge_into(spark, p, spark.createDataFrame([("b", D(2023, 1, 6), "web", 2), ("n3", None, "web", 2)], kind), _merge_all)
    got = {r.order_key: r.qty for r in spark.read.parquet(p).collect()}
    assert got == {"a": 1, "n1": 1, "n2": 1, "b": 2, "n3": 2}
    layout.merge_into(spark, p, spark.createDataFrame([("n2", None, "app", 7)], kind), _merge_all)
    assert {r.order_key: r.qty for r in spark.read.parquet(p).collect()} == {**got, "n2": 7}


@pytest.mark.parametrize("name", ["date_channel", "day_customer_channel"])
def test_merge_follows_moved_dates_and_drops_emptied_partitions(spark, scratch, name):
    p = os.path.join(scratch, "f")
    kind = "order_key string, customer_id string, order_date date, channel string, qty int"
    rows = [("a", "c", D(2023, 1, 31), "web", 1), ("b", "c", D(2023, 2, 3), "web", 1), ("z", "c", D(2023, 5, 3), "web", 1)]
    layout.write_layout(spark.createDataFrame(rows, kind), p, name)
    untouched = {f for f in os.listdir(os.path.join(p, f"{layout.partition_col(name)}=2023-05-{'01' if name == 'date_channel' else '03'}"))}
    batch = spark.createDataFrame([("a", "c", D(2023, 3, 1), "web", 9), ("b", "c", None, "web", 9)], kind)
    layout.merge_into(spark, p, batch, _merge_all, name)
    got = sorted((r.order_key, str(r.order_date), r.qty) for r in spark.read.parquet(p).collect())
    assert got == [("a", "2023-03-01", 9), ("b", "None", 9), ("z", "2023-05-03", 1)]
    parts = sorted(f.split("=")[1][:7] for f in os.listdir(p) if "=" in f)
    assert parts == ["2023-03", "2023-05", "__HIVE_"]
    kept = os.path.join(p, f"{layout.partition_col(name)}=2023-05-{'01' if name == 'date_channel' else '03'}")
    assert set(os.listdir(kept)) == untouched  # only the touched partitions are rewritten


@pytest.mark.parametrize("name", ["date", "date_channel", "day_customer_channel", "customer"])
def test_every_written_file_is_sorted(spark, scratch, name):
    import glob

    import pyarrow.parquet as pq
    p = os.path.join(scratch, "f")
    layout.write_layout(_fact(spark, 3000).withColumn("order_key", F.md5("order_key")), p, name, files=3)
    files = glob.glob(f"{p}/**/*.parquet", recursive=True)
    assert len(files) > 2
    for f in files:
        rows = pq.ParquetFile(f).read(columns=list(layout.LAYOUTS[name].cluster)).to_pylist()
        keys = [tuple(r[c] for c in layout.LAYOUTS[name].cluster) for r in rows]
        assert keys == sorted(keys), f


def test_recluster_takes_the_disordered_partitions_only(spark, scratch):
    p = os.path.join(scratch, "f")
    f = _fact(spark, 600)
    layout.write_layout(f, p, "date_channel", files=1)
    # a backfill appends another file to January
    extra = layout.with_partition_col(f.filter(F.month("order_date") == 1).withColumn("order_key", F.concat(F.lit("x"), "order_key")))
    extra.coalesce(1).write.mode("append").partitionBy(layout.PARTITION_COL).parquet(p)
    assert layout.disordered_partitions(spark, p) == [D(2023, 1, 1)]
    feb = set(os.listdir(os.path.join(p, "order_month=2023-02-01")))
    layout.recluster(spark, p)
    assert layout.disordered_partitions(spark, p) == []
    assert set(os.listdir(os.path.join(p, "order_month=2023-02-01"))) == feb
    assert spark.read.parquet(p).count() == 600 + extra.count()


def test_watermark_reads_the_newest_partition(spark, scratch):
    p = os.path.join(scratch, "f")
    layout.write_layout(_fact(spark), p)
    t = spark.read.parquet(p)
    assert upsert.watermark(t, 3, partition=layout.PARTITION_COL) == upsert.watermark(t, 3)
    assert upsert.watermark(t.filter(F.lit(False)), 3, partition=layout.PARTITION_COL) is None


def test_one_sided_date_ranges(spark):
    from starloom.operators import marts
    f = _fact(spark)
    n = {k: marts.full_range_sum(f, *v).first().order_lines for k, v in
         {"from": ("2023-07-01", None), "to": (None, "2023-06-30"), "all": (None, None)}.items()}
    assert n["from"] + n["to"] == n["all"] == 200 and n["from"] > 0


def test_broadcast_is_measured_in_bytes(spark):
    from starloom.operators.joins import checked_broadcast, measured_bytes
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "k int, s string").checkpoint()
    assert 1000 <= measured_bytes(df) <= 1100
    assert checked_broadcast(df, 500) is df and checked_broadcast(df, 5000) is not df


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from starloom.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_typed_table_is_created_once_and_filled_with_defaults(spark, scratch):
    from starloom.operators import schemas
    p = os.path.join(scratch, "dim")
    assert schemas.create_if_absent(spark, p, schemas.DIM_CUSTOMER_SCHEMA)
    now = dt.datetime(2024, 1, 1)
    row = spark.createDataFrame([("k", "c", now)], "customer_key string, customer_id string, valid_from timestamp_ntz")
    schemas.append_conformed(row, p, schemas.DIM_CUSTOMER_SCHEMA, schemas.DIM_CUSTOMER_DEFAULTS, as_of=now)
    assert not schemas.create_if_absent(spark, p, schemas.DIM_CUSTOMER_SCHEMA)
    r = spark.read.parquet(p).select("*", F.col("valid_to").cast("string").alias("end")).first()
    assert (r.end, r.is_current, r.dw_created_at, r.city) == ("9999-12-31 23:59:59", True, now, None)


def test_retention(spark, scratch):
    p = os.path.join(scratch, "f")
    layout.write_layout(_fact(spark), p, "date_channel", files=2)
    undated = layout.with_partition_col(_fact(spark, 3).withColumn("order_date", F.lit(None).cast("date")))
    undated.write.mode("append").partitionBy(layout.PARTITION_COL).parquet(p)
    dropped = layout.drop_expired_partitions(spark, p, dt.datetime(2023, 7, 15), days=100)
    assert spark.read.parquet(p).filter("order_date IS NULL").count() == 3
    assert dropped == [D(2023, m, 1) for m in (1, 2, 3)]
    assert spark.read.parquet(p).agg(F.min("order_month")).first()[0] == D(2023, 4, 1)


def test_m29_job_log(spark):
    now = dt.datetime(2024, 1, 2, 12)
    hour = dt.timedelta(hours=1)
    rows = [("j1", "SELECT", "QUERY", 2_000_000_000, 5000, now - hour, now - hour + dt.timedelta(seconds=7), now - hour, "q1"),
            ("j2", "INSERT", "LOAD", 1, 1, now - hour, now, now - hour, "l"),
            ("j3", "SELECT", "QUERY", 1, 1, now - 48 * hour, now - 47 * hour, now - 48 * hour, "q3")]
    log = spark.createDataFrame(rows, "job_id string, statement_type string, job_type string, "
                                      "total_bytes_processed long, total_slot_ms long, start_time timestamp_ntz, "
                                      "end_time timestamp_ntz, creation_time timestamp_ntz, query string")
    out = ops.job_log_report(log, now).collect()
    assert [(r.job_id, r.gb_processed, r.slot_seconds, r.wall_seconds) for r in out] == [("j1", 2.0, 5.0, 7)]


def test_m32_layouts_same_rows_different_pruning(spark, scratch):
    f = _fact(spark)
    p1, p2 = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    layout.write_layout(f, p1, "date_channel", files=4)
    layout.write_layout(f, p2, "customer", files=4)
    a = spark.read.parquet(p1).drop("order_month")
    b = spark.read.parquet(p2)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    ra, rb = (ops.files_holding(spark.read.parquet(p), F.col("customer_id") == "c3").first() for p in (p1, p2))
    assert rb.files_hit < ra.files_hit and rb.bytes_hit < rb.bytes_total


def test_schema_evolution_merge_schema(spark, scratch):
    p = os.path.join(scratch, "f")
    old = _fact(spark, 40).filter(F.month("order_date") <= 6)
    new = _fact(spark, 40).filter(F.month("order_date") > 6).withColumn("currency_key", F.lit("USD"))
    layout.write_layout(old, p, "date_channel", files=2)
    layout.write_layout(new, p, "date_channel", files=2)  # dynamic overwrite keeps old months
    df = layout.read_fact(spark, p, "2023-01-01", "2023-12-31", merge_schema=True)
    assert "currency_key" in df.columns and df.count() == 40
    assert df.filter(F.col("currency_key").isNull()).count() == old.count()
