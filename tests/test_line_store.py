"""Stored order lines: months, waiting lines, repeated and broken-off batches."""

import datetime as dt

import pytest

from starloom.operators import layout
from starloom.sources.line_store import LineStore

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_returnflag string, l_shipdate timestamp_ntz, note string")
ORDERS = "o_orderkey long, o_orderdate timestamp_ntz"


def line(order, number=1, flag="N", ship=dt.datetime(2000, 6, 1)):
    return (order, 1, 1, number, 1.0, 10.0, 0.0, flag, ship, "x")


@pytest.fixture
def given(spark, tmp_path):
    days = [dt.datetime(2000, 1, 31, 9), dt.datetime(2000, 2, 1), dt.datetime(2000, 2, 20, 23), None]
    orders = spark.createDataFrame(list(enumerate(days)) + [(1, days[1])], ORDERS)  # one order comes twice
    lines = spark.createDataFrame([line(k, n) for k in range(5) for n in (1, 2)] + [line(0)], LINES)
    return LineStore(spark, str(tmp_path / "lines")), lines, orders


def held(rows):
    return sorted((r.l_orderkey, r.l_linenumber) for r in rows.collect())


def test_lines_are_found_by_the_day_of_their_order(spark, given):
    store, lines, orders = given
    store.add(lines, orders)
    assert held(store.between()) == [(k, n) for k in range(5) for n in (1, 2)]
    assert held(store.between("2000-02-01", "2000-02-19")) == [(1, 1), (1, 2)]
    assert held(store.between(until="2000-01-31")) == [(0, 1), (0, 2)]
    assert held(store.between(since="2000-02-02")) == [(2, 1), (2, 2)]
    assert held(store.waiting()) == [(k, n) for k in (3, 4) for n in (1, 2)]
    assert tuple(store.batch_report("2000-02-20").first()) == (10, 4, 2)
    plan = store.between("2000-02-01", "2000-02-19")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "GreaterThanOrEqual(order_date" in plan


def test_waiting_lines_go_to_their_month_when_the_order_comes(spark, given):
    store, lines, orders = given
    store.add(lines, orders.where("o_orderkey < 2"))
    assert held(store.between("2000-02-02")) == []
    late = spark.createDataFrame([(2, dt.datetime(2000, 2, 20)), (4, dt.datetime(2000, 3, 5))], ORDERS)
    for _ in range(2):  # the second time nothing is left to do
        store.settle(late)
        assert held(store.between("2000-02-02")) == [(2, 1), (2, 2), (4, 1), (4, 2)]
        assert held(store.waiting()) == [(3, 1), (3, 2)]
        assert store.between().count() == 10
    store.settle(late.limit(0))
    assert store.between().count() == 10


def test_a_batch_that_comes_again_is_stored_once(spark, given):
    store, lines, orders = given
    store.add(lines.limit(0), orders)
    for _ in range(2):
        store.add(lines, orders)
        assert store.between().count() == 10
    store.add(spark.createDataFrame([line(1, 1, "R"), line(1, 3)], LINES), orders)
    assert {(r.l_linenumber, r.l_returnflag) for r in store.between("2000-02-01", "2000-02-01").collect()} == {(1, "R"), (2, "N"), (3, "N")}


def test_a_stream_keeps_what_an_earlier_run_wrote(spark, tmp_path):
    """Two runs write to one month; the second does not know the first one's rows."""
    from starloom.operators.upsert import MERGE_CHANGE_COLS, MERGE_UPDATE_COLS
    from starloom.streaming.stream import stream_fact_upsert
    extra = sorted({*MERGE_UPDATE_COLS, *MERGE_CHANGE_COLS} - {"order_key", "order_date", "channel", "dw_loaded_at"})
    schema = "order_key string, order_date date, channel string, dw_loaded_at timestamp_ntz, " + ", ".join(f"{c} int" for c in extra)
    path = str(tmp_path / "fact")
    for i in range(3):
        spark.createDataFrame([(f"k{i}", dt.date(2000, 1, 1 + i), "web", None, *[1] * len(extra))], schema) \
            .write.mode("append").parquet(str(tmp_path / "landing"))
        q = stream_fact_upsert(spark, str(tmp_path / "landing"), schema, path, str(tmp_path / "cp"), lambda b: b)
        q.awaitTermination()
        assert sorted(r.order_key for r in spark.read.parquet(path).collect()) == [f"k{k}" for k in range(i + 1)]


def test_a_batch_broken_off_is_made_good(spark, given, monkeypatch):
    store, lines, orders = given
    store.add(lines.where("l_orderkey < 2"), orders)
    whole = layout._replace

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(layout, "_replace", broken)
    with pytest.raises(RuntimeError):
        store.add(lines, orders)
    monkeypatch.setattr(layout, "_replace", whole)
    store.add(lines, orders)
    assert held(store.between()) == [(k, n) for k in range(5) for n in (1, 2)]
