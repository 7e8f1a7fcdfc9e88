"""The seasonal forecast against plain Python, and cleansed staging rows."""

import datetime as dt
from decimal import Decimal

from starloom.operators.forecast import region_forecast_gap, seasonal_forecast
from starloom.sources import staging

MONTHLY = "region string, month date, revenue decimal(18,2)"


def month(i):
    return dt.date(1999 + i // 12, i % 12 + 1, 1)


def plain(values, ahead):
    """One forecast per month and ``ahead`` more, by the textbook recurrence."""
    if len(values) < 12:
        return [None] * len(values)
    level, trend = sum(values[:12]) / 12, 0.0
    season, out = {i: v - level for i, v in enumerate(values[:12])}, [None] * 12
    for t, y in list(enumerate(values))[12:]:
        s = season[t - 12]
        out.append(level + trend + s)
        before, level = level, 0.25 * (y - s) + 0.75 * (level + trend)
        trend = 0.125 * (level - before) + 0.875 * trend
        season[t] = 0.5 * (y - level) + 0.5 * s
    n = len(values)
    return out + [level + k * trend + season[n - 12 + (k - 1) % 12] for k in range(1, ahead + 1)]


def test_forecast_matches_the_recurrence(spark):
    # a season with growth; month 17 is missing, 20 is null, 30 comes in two rows
    values = [100.0 + 3 * i + (40 if i % 12 in (10, 11) else 0) for i in range(40)]
    rows = [("a", month(i), Decimal(str(v))) for i, v in enumerate(values) if i not in (17, 20, 30)]
    rows += [("a", month(20), None), ("a", month(30), Decimal("100")), ("a", month(30), Decimal(str(values[30] - 100)))]
    rows += [("short", month(i), Decimal(5)) for i in range(11)] + [("year", month(i), Decimal(i)) for i in range(12)]
    values[17] = values[20] = 0.0
    got = seasonal_forecast(spark.createDataFrame(rows, MONTHLY), ahead=14).collect()
    for name, series in (("a", values), ("short", [5.0] * 11), ("year", [float(i) for i in range(12)])):
        mine = sorted((r for r in got if r.region == name), key=lambda r: r.month)
        want = plain(series, 14)
        assert [r.month for r in mine] == [month(i) for i in range(len(want))]
        assert [r.forecast for r in mine] == want
        assert [None if r.revenue is None else float(r.revenue) for r in mine] == series + [None] * (len(want) - len(series))


def test_forecast_of_a_flat_series_and_of_nothing(spark):
    flat = spark.createDataFrame([("a", month(i), Decimal(7)) for i in range(30)], MONTHLY)
    found = seasonal_forecast(flat)
    assert {r.forecast for r in found.collect() if r.forecast is not None} == {7.0}
    assert {(r.year, r.months, r.status) for r in region_forecast_gap(found).collect()} == {(2000, 12, "on_or_above"), (2001, 6, "on_or_above")}
    assert seasonal_forecast(flat.limit(0)).count() == 0
    assert seasonal_forecast(flat, ahead=0).count() == 30


def test_orders_are_trimmed_and_taken_once(spark):
    day = dt.datetime(2000, 1, 2)
    raw = spark.createDataFrame([
        (1, 5, " f ", 1.0, day, "1-high"), (1, 5, "O", 1.0, dt.datetime(2000, 1, 1), "1-high"), (1, 5, " f ", 1.0, day, "1-high"),
        (2, 5, "  ", 2.0, day, ""), (2, 5, "F", 2.0, None, "x"), (None, None, None, None, None, None), (None, None, None, None, None, None)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    got = {r.o_orderkey: (r.o_orderstatus, r.o_orderdate, r.o_orderpriority) for r in staging.clean_orders(raw).collect()}
    assert got == {1: ("F", day, "1-HIGH"), 2: (None, day, None), None: (None, None, None)}
    assert staging.clean_orders(raw).count() == 3 and staging.clean_orders(raw.limit(0)).count() == 0


def test_customers_are_taken_once_and_listed_without_order(spark):
    raw = spark.createDataFrame([(1, " Ann", 3, 1.0, "auto "), (1, "Ann", 3, 1.0, "AUTO"), (2, "", 3, None, None), (3, "Cy", 3, 1.0, "x")],
                                "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    clean = staging.clean_customers(raw)
    assert sorted((r.c_custkey, r.c_name, r.c_mktsegment) for r in clean.collect()) == [(1, "Ann", "AUTO"), (2, None, None), (3, "Cy", "X")]
    orders = spark.createDataFrame([(1,), (1,), (None,)], "o_custkey long")
    assert sorted(r.customer_id for r in staging.customers_without_order(clean, orders).collect()) == ["2", "3"]
