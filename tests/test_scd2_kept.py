"""Type-2 dimensions kept by a stream's state and by a bucketed store, against the plain merge."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout, scd2
from starloom.operators import scd2_store as store_module
from starloom.operators.scd2_store import BUCKET, Scd2Store
from starloom.streaming.keyed_scd2 import dimension, refused_rows, stream_scd2_state

T0 = dt.datetime(2020, 1, 1)
SCHEMA = "id string, grade string, amount decimal(20,2), seen date, n long, active boolean, updated_at timestamp_ntz"
KW = dict(natural_key="id", tracked=["grade", "active"], attributes=["grade", "amount", "seen", "n", "active"], as_of=T0)
BIG = 2 ** 53 + 1


def change(key, day, grade, n=1):
    at = None if day is None else T0 + dt.timedelta(days=day, microseconds=500_000 if day % 2 else 0)
    return (key, grade, None if n is None else n, None if n is None else T0.date(), n, None if n is None else n % 2 == 0, at)


def make(spark, rows):
    rows = [(r[0], r[1], None if r[2] is None else Decimal(r[2]), *r[3:]) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def random_batches(seed, n=3):
    rnd, at = random.Random(seed), 0
    for _ in range(n):
        rows = {}
        for _ in range(40):
            key, day = rnd.choice("abcdefgh") if rnd.random() < .6 else "hot", at + rnd.randrange(60)
            rows[key, day] = change(key, day, rnd.choice(["x", "y", None, ""]), rnd.choice([2, 3, BIG, None]))
        yield list(rows.values())
        at += rnd.choice([0, 40, 60])  # 0 and 40: later batches hold late rows


def rows(df):
    cols = sorted(c for c in df.columns)
    return sorted(map(str, df.select(*[F.col(c).cast("string") for c in cols]).collect()))


def plain(spark, batches):
    dim, rejected = scd2.empty_like_dim(make(spark, []), "id", KW["attributes"]), []
    for b in batches:
        dim, rej = scd2.scd2_merge(dim, make(spark, b), **KW)
        dim = dim.checkpoint()
        rejected += rows(rej)
    return rows(dim), sorted(rejected)


def stream(spark, scratch, batches):
    log = f"{scratch}/log"
    for b in batches:
        make(spark, b).write.mode("append").parquet(f"{scratch}/landing")
        stream_scd2_state(spark, f"{scratch}/landing", make(spark, []).schema, log, f"{scratch}/ckpt", **KW)
    return spark.read.parquet(log)


SHAPE = dict(natural_key="id", attributes=KW["attributes"])


@pytest.mark.parametrize("seed", [1])
def test_state_and_store_equal_the_plain_merge(spark, scratch, seed):
    batches = list(random_batches(seed))
    expected, rejected = plain(spark, batches)
    log = stream(spark, scratch, batches)
    assert rows(dimension(log, **SHAPE)) == expected
    assert log.filter("event = 'open'").count() == len(expected)  # a row per version, whatever the number of batches
    assert rows(refused_rows(log, tracked=KW["tracked"], **SHAPE)) == rejected
    store, refused = Scd2Store(spark, f"{scratch}/store", buckets=3, **KW), []
    for b in batches:
        refused += rows(store.merge(make(spark, b)))
    assert rows(store.read()) == expected
    assert sorted(refused) == rejected


def test_a_repeated_batch_and_an_empty_one_change_nothing(spark, scratch):
    batch = [change("a", 0, "x"), change("a", 2, "y"), change("b", 0, "x")]
    expected, _ = plain(spark, [batch])
    log = stream(spark, scratch, [batch, batch, []])
    assert rows(dimension(log, **SHAPE)) == expected and log.count() == len(expected) + 1
    assert refused_rows(log, tracked=KW["tracked"], **SHAPE).isEmpty()  # a's first change again agrees with what was
    store = Scd2Store(spark, f"{scratch}/store", **KW)
    for b in (batch, batch, []):
        assert store.merge(make(spark, b)).isEmpty()
    assert rows(store.read()) == expected


def test_rows_without_key_or_time_and_torn_rows_are_refused_by_the_stream(spark, scratch):
    log = stream(spark, scratch, [[change("a", 0, "x"), change("a", 0, "z"), change(None, 0, "x"), change("b", None, "x")]])
    assert [r.id for r in dimension(log, **SHAPE).collect()] == ["a"]
    assert refused_rows(log, tracked=KW["tracked"], **SHAPE).count() == 3


def files(spark, store, part):
    return {r[0] for r in store._stored(part).select(F.col("_metadata.file_path")).distinct().collect()}


def test_a_merge_writes_the_buckets_it_changes(spark, scratch):
    store = Scd2Store(spark, f"{scratch}/store", buckets=16, **KW)
    store.merge(make(spark, [change(f"k{i}", 0, "x") for i in range(200)]))
    before = files(spark, store, "current")
    store.merge(make(spark, [change("k7", 9, "y"), change("k8", 9, "x")]))  # k8 stays as it is
    gone = before - files(spark, store, "current")
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in gone} == {
        str(r[0]) for r in store._stored("current").filter("id = 'k7'").select(BUCKET).collect()}
    assert store._stored("closed").count() == 1
    closed = files(spark, store, "closed")
    store.merge(make(spark, [change("k7", 11, "z")]))
    assert closed < files(spark, store, "closed")  # what had ended is not written again
    assert Scd2Store(spark, f"{scratch}/store", buckets=5, **KW).buckets == 16


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["publish", "closed", "current", "after"])
def test_a_merge_broken_off_and_run_again_is_as_if_run_once(spark, scratch, monkeypatch, step):
    first = [change(f"k{i}", 0, "x") for i in range(30)]
    second = [change(f"k{i}", d, f"v{d}") for i in range(0, 30, 2) for d in (4, 6)]
    expected, _ = plain(spark, [first, second])
    store = Scd2Store(spark, f"{scratch}/store", buckets=4, **KW)
    store.merge(make(spark, first))
    calls, real = {"n": 0}, store_module._write

    def fails(*a):
        calls["n"] += 1
        if step != "closed" and (step == "after" or calls["n"] == 1):
            real(*a)
        if calls["n"] == {"closed": 1, "current": 2, "after": 2}[step]:
            raise Broken

    def refuses(*a):
        raise Broken
    with monkeypatch.context() as m:
        m.setattr(layout, "publish", refuses) if step == "publish" else m.setattr(store_module, "_write", fails)
        with pytest.raises(Broken):
            store.merge(make(spark, second))
    store.merge(make(spark, second))
    assert rows(store.read()) == expected


def test_state_is_kept_and_worked_on_by_bucket(spark, scratch):
    """Python is called, and a state row kept, once per bucket and not per key."""
    batches = [[change(f"k{k}", day, g, 2) for k in range(60)] + [change(None, day, g, 2)] for day, g in ((1, "x"), (5, "y"), (3, "z"))]
    expected, rejected = plain(spark, [b[:-1] for b in batches])
    for b in batches:
        make(spark, b).write.mode("append").parquet(f"{scratch}/landing")
        stream_scd2_state(spark, f"{scratch}/landing", make(spark, []).schema, f"{scratch}/log", f"{scratch}/ckpt", buckets=4, **KW)
    log = spark.read.parquet(f"{scratch}/log")
    assert rows(dimension(log, **SHAPE)) == expected
    assert log.filter("event = 'refused' and id is null").count() == 3
    assert rows(refused_rows(log.filter("id is not null"), tracked=KW["tracked"], **SHAPE)) == rejected
    assert spark.read.format("statestore").load(f"{scratch}/ckpt").count() <= 4
