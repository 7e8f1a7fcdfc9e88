"""SCD2 merge, history and integrity checks on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import quality, scd2
from starloom.operators.pit import pit_join

TS = dt.datetime
MAX = "9999-12-31 23:59:59"
ATTRS = ["customer_segment", "city", "state", "country", "is_active"]


def feed(spark, rows):
    """rows: (customer_id, segment, updated_at[, city, email])"""
    out = []
    for r in rows:
        cid, seg, ts = r[:3]
        city = r[3] if len(r) > 3 else "C"
        email = r[4] if len(r) > 4 else "e@x"
        out.append((cid, email, "n", "f", "l", "ch", None, seg, None, city, "S", "X", True, ts))
    schema = ("customer_id string, email string, full_name string, first_name string, last_name string, "
              "acquisition_channel string, acquisition_date date, customer_segment string, "
              "lifetime_value decimal(12,2), city string, state string, country string, is_active boolean, "
              "updated_at timestamp_ntz")
    return spark.createDataFrame(out, schema)


def merge(spark, dim, rows, as_of=TS(2024, 1, 1)):
    inc = feed(spark, rows)
    if dim is None:
        dim = scd2.empty_like_dim(inc)
    return scd2.scd2_merge(dim, inc, as_of=as_of)


def rows_of(dim):
    return sorted((r.customer_id, r.customer_segment, r.valid_from, str(r.valid_to), r.is_current)
                  for r in dim.collect())


def test_m1_new_key(spark):
    dim, rej = merge(spark, None, [("c1", "Bronze", TS(2023, 1, 1))])
    assert rows_of(dim) == [("c1", "Bronze", TS(2023, 1, 1), MAX, True)]
    assert rej.count() == 0


def test_m2_close_and_open(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 1, 1))])
    d2, _ = merge(spark, d1, [("c1", "Gold", TS(2023, 3, 15))])
    assert rows_of(d2) == [
        ("c1", "Gold", TS(2023, 3, 15), MAX, True),
        ("c1", "Silver", TS(2023, 1, 1), "2023-03-14 23:59:59", False),
    ]


def test_m3_rerun_is_noop(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 1, 1))])
    d2, _ = merge(spark, d1, [("c1", "Gold", TS(2023, 3, 15))])
    d3, rej = merge(spark, d2.checkpoint(), [("c1", "Gold", TS(2023, 3, 15))])
    assert rows_of(d3) == rows_of(d2)
    assert rej.count() == 0


def test_m4_as_of_long_after_change(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 1, 1))])
    for later in (TS(2023, 3, 15, 2), TS(2024, 3, 15)):
        d2, _ = merge(spark, d1, [("c1", "Gold", TS(2023, 3, 15))], as_of=later)
        assert [r[1] for r in rows_of(d2) if r[4]] == ["Gold"]
        assert len(rows_of(d2)) == 2


def test_m5_separator_and_null_marker(spark):
    from starloom.functions.keys import change_hash, concat_hash
    df = spark.createDataFrame([("ab", "c", "a", "bc", None, "")], "a string, b string, c string, d string, e string, f string")
    r = df.select(
        (change_hash(["a", "b"]) == change_hash(["c", "d"])).alias("sep"),
        (change_hash(["e"]) == change_hash(["f"])).alias("null"),
        (concat_hash(["a", "b"]) == concat_hash(["c", "d"])).alias("literal_sep"),
    ).first()
    assert r.sep is False and r.null is False
    assert r.literal_sep is True  # the literal form cannot tell them apart


def test_m6_untracked_change_no_version(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 1, 1), "C", "old@x")])
    d2, _ = merge(spark, d1, [("c1", "Silver", TS(2023, 2, 1), "C", "new@x")])
    assert rows_of(d2) == rows_of(d1)
    assert d2.first().email == "old@x"


def test_m7_two_changes_one_batch(spark):
    d1, _ = merge(spark, None, [("c1", "Bronze", TS(2023, 1, 1))])
    d2, _ = merge(spark, d1, [("c1", "Silver", TS(2023, 2, 1)), ("c1", "Gold", TS(2023, 3, 1))])
    assert rows_of(d2) == [
        ("c1", "Bronze", TS(2023, 1, 1), "2023-01-31 23:59:59", False),
        ("c1", "Gold", TS(2023, 3, 1), MAX, True),
        ("c1", "Silver", TS(2023, 2, 1), "2023-02-28 23:59:59", False),
    ]
    assert quality.assert_scd2(d2, strict=True).count() == 0


def test_m8_change_before_current_rejected(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 3, 1))])
    d2, rej = merge(spark, d1, [("c1", "Gold", TS(2023, 2, 1))])
    assert rows_of(d2) == rows_of(d1)
    assert [r.customer_id for r in rej.collect()] == ["c1"]


def test_two_rows_of_one_key_and_timestamp(spark):
    import pytest
    same = [("c1", "Bronze", TS(2023, 1, 1)), ("c1", "Gold", TS(2023, 1, 1))]
    with pytest.raises(scd2.AmbiguousVersionError):
        merge(spark, None, same)
    inc = feed(spark, same).withColumn("seq", F.when(F.col("customer_segment") == "Gold", 2).otherwise(1))
    dim, rej = scd2.scd2_merge(scd2.empty_like_dim(inc), inc, as_of=TS(2024, 1, 1), order_by="seq")
    assert rows_of(dim) == [("c1", "Gold", TS(2023, 1, 1), MAX, True)] and rej.count() == 0
    # rows that agree in the tracked attributes are one
    dim, _ = merge(spark, None, [("c1", "Gold", TS(2023, 1, 1), "C", "a@x"), ("c1", "Gold", TS(2023, 1, 1), "C", "b@x")])
    assert len(rows_of(dim)) == 1


def test_stream_writes_rejects_and_survives_a_crashed_version(spark, scratch):
    import os

    from starloom.operators import layout
    from starloom.streaming.stream import stream_scd2
    landing, base, ckpt, rejects = (os.path.join(scratch, n) for n in ("in", "dim", "ckpt", "rej"))

    def arrive(rows):
        df = feed(spark, rows)
        df.repartition(2).write.mode("append").parquet(landing)
        stream_scd2(spark, landing, df.schema, base, ckpt, rejects, as_of=TS(2024, 1, 1))

    arrive([("c1", "Bronze", TS(2023, 1, 1)), ("c2", "Gold", TS(2023, 1, 1))])
    os.makedirs(os.path.join(base, "v=2"))  # a crash before the commit
    arrive([("c1", "Silver", TS(2023, 2, 1)), ("c2", "Late", TS(2022, 1, 1))])
    got = rows_of(layout.read_versioned(spark, base))
    assert [(r[0], r[1], r[4]) for r in got] == [("c1", "Bronze", False), ("c1", "Silver", True), ("c2", "Gold", True)]
    assert [(r.customer_id, r.customer_segment) for r in spark.read.parquet(rejects).collect()] == [("c2", "Late")]


def test_m9_pit_minus_1s_convention(spark):
    d1, _ = merge(spark, None, [("c1", "Silver", TS(2023, 1, 1))])
    d2, _ = merge(spark, d1, [("c1", "Gold", TS(2023, 3, 15))])
    orders = spark.createDataFrame(
        [("o1", "c1", TS(2023, 3, 14)), ("o2", "c1", TS(2023, 3, 14, 23, 59, 59, 500000)),
         ("o3", "c1", TS(2023, 3, 15))], "order_id string, customer_id string, t timestamp_ntz")
    out = pit_join(orders, d2, at="t", take=("customer_segment",), convention=scd2.MINUS_1S)
    got = {r.order_id: r.customer_segment for r in out.collect()}
    assert got == {"o1": "Silver", "o2": "Silver", "o3": "Gold"}


def test_m10_date_vs_timestamp(spark):
    snap = scd2.scd2_history(feed(spark, [("c1", "Bronze", TS(2023, 1, 1, 10))]))
    dim = scd2.dim_from_snapshot(snap, as_of=TS(2024, 1, 1))
    o = spark.createDataFrame([("o1", "c1", dt.date(2023, 1, 1), TS(2023, 1, 1, 12))],
                              "order_id string, customer_id string, order_date date, order_timestamp timestamp_ntz")
    by_date = pit_join(o, dim, at="order_date").first().customer_key
    by_ts = pit_join(o, dim, at="order_timestamp").first().customer_key
    assert by_date is None and by_ts is not None


def test_history_collapses_and_contiguous(spark):
    f = feed(spark, [("c1", "Bronze", TS(2023, 1, 1)), ("c1", "Bronze", TS(2023, 1, 5)),
                     ("c1", "Gold", TS(2023, 2, 1))])
    dim = scd2.dim_from_snapshot(scd2.scd2_history(f), as_of=TS(2023, 3, 1))
    rows = sorted(dim.select("customer_segment", "valid_from", F.col("valid_to").cast("string"),
                             "version_number", "days_active").collect(), key=lambda r: r[1])
    assert [tuple(r) for r in rows] == [
        ("Bronze", TS(2023, 1, 1), "2023-02-01 00:00:00", 1, 31),
        ("Gold", TS(2023, 2, 1), MAX, 2, 28),
    ]
    assert quality.assert_scd2(dim, strict=True).count() == 0


def test_merge_sequence_equals_history(spark):
    """Merging snapshots one by one == history over their union (T4 aside)."""
    rows = [("c1", "Bronze", TS(2023, 1, 1)), ("c1", "Silver", TS(2023, 2, 1)), ("c2", "Gold", TS(2023, 1, 7)),
            ("c1", "Gold", TS(2023, 3, 1)), ("c2", "Gold", TS(2023, 3, 2))]
    dim = None
    for batch in ([rows[0], rows[2]], [rows[1]], [rows[3], rows[4]]):
        dim, _ = merge(spark, dim, batch)
        dim = dim.checkpoint()
    hist = scd2.scd2_history(feed(spark, rows))
    got = sorted((r.customer_id, r.valid_from) for r in dim.collect())
    exp = sorted((r.customer_id, r.dbt_valid_from) for r in hist.collect())
    assert got == exp


def _dim(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, "
                                       "is_current boolean")


def test_m17_no_current_row(spark):
    d = _dim(spark, [("c1", TS(2023, 1, 1), TS(2023, 2, 1), False)])
    assert quality.assert_scd2(d).count() == 0
    assert quality.scd2_current_count(d, strict=True).count() == 1


def test_m18_gap_before_current(spark):
    d = _dim(spark, [("c1", TS(2023, 1, 1), TS(2023, 1, 31, 23, 59, 55), False),
                     ("c1", TS(2023, 2, 1), TS(9999, 12, 31, 23, 59, 59), True)])
    assert quality.assert_scd2(d).count() == 0
    assert quality.scd2_gaps(d, strict=True).count() == 1


def test_m19_overlap(spark):
    d = _dim(spark, [("c1", TS(2023, 1, 1), TS(2023, 3, 1), False),
                     ("c1", TS(2023, 2, 1), TS(9999, 12, 31, 23, 59, 59), True)])
    assert quality.assert_scd2(d).count() == 0
    issues = {r.issue for r in quality.assert_scd2(d, strict=True).collect()}
    assert issues == {"overlapping_versions"}


def test_m20_empty_range(spark):
    d = _dim(spark, [("c1", TS(2023, 1, 1), TS(2023, 1, 1), True)])
    assert [r.issue for r in quality.assert_scd2(d).collect()] == ["invalid_date_range"]


def test_merge_works_its_batch_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = feed(spark, [(f"c{i % 40}", f"S{i // 40}", TS(2023, 1, 1 + i // 40)) for i in range(200)])
    batch = rows.mapInArrow(counted, rows.schema)
    dim, rejected = scd2.scd2_merge(scd2.empty_like_dim(rows), batch, as_of=TS(2024, 1, 1))
    assert (dim.count(), dim.filter("is_current").count(), rejected.count()) == (200, 40, 0)
    assert seen.value == 200


def test_snapshots_read_the_stored_feed(spark):
    from starloom.plans import catalog
    from starloom.plans.warehouse import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    snapshots = catalog._snapshots(w)
    assert all("customer_feed" in f for s in snapshots for f in s.inputFiles())
    assert sorted(map(tuple, w.customer_feed.collect()), key=repr) == sorted(map(tuple, w.stg_customers.collect()), key=repr)
