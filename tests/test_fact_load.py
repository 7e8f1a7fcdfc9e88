"""The load of the whole fact: lookups per order and product, keys made behind the last shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts, layout
from starloom.plans.warehouse import Warehouse
from starloom.sources import staging

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "FRANCE", 0), (1, "JAPAN", 1), (2, "NOWHERE", None)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                 [(k, f"Customer#{k:09d}", k % 3, 1.0, "AUTO") for k in range(1, 9)] + [(9, None, None, None, None)]),
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(k, f"a b{k}", "B", "T", k, 10.25 + k) for k in range(1, 6)] + [(5, "twice b5", "B", "T", 5, 15.25), (6, None, None, None, None, None)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
               [(k, k % 11, "O" if k % 2 else "F", 400_000.0, dt.datetime(2000, 1 + k % 6, 1 + k % 28, k % 24), "1-URGENT") for k in range(60)]
               + [(7, 3, "O", 1.0, dt.datetime(2000, 3, 3), "1-URGENT"), (60, None, None, None, None, None)]),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                 [(k % 63, 1 + k % 8, k % 4, k % 5, float(k % 50), 100.0 + k, (k % 10) / 100, 0.0, "NRA"[k % 3], "O", dt.datetime(2000, 7, 1 + k % 28))
                  for k in range(300)] + [(1, None, None, None, None, None, None, None, None, None, None)] * 2),
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_loaded_fact_is_the_fact_of_staged_lines(spark, raw, tmp_path):
    w = Warehouse(spark, raw, as_of=dt.datetime(2001, 1, 1), root=str(tmp_path / "wh"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for bound in (kept, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
            path = str(tmp_path / f"fact{bound}")
            w.load_fact(path)
            new = layout.without_partition_col(spark.read.parquet(path))
            old = w.fact_for(w.stg_orders)
            assert new.columns == old.columns == facts.FACT_COLUMNS
            assert old.count() == new.count() > 300
            assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()
        assert new.filter("customer_key is null").count() and new.filter("product_key is null").count()
        w.load_fact(path + "-part", until="2000-03-31")
        part = layout.without_partition_col(spark.read.parquet(path + "-part"))
        assert part.exceptAll(w.fact_for(staging.stg_orders(spark, raw, until="2000-03-31"))).isEmpty()
        assert part.count() == new.filter(F.col("order_date") <= "2000-03-31").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_lines_are_shuffled_without_what_can_be_made_again(spark, raw, tmp_path, monkeypatch):
    """However large customers and products are, lines are shuffled by product, by order and by
    the layout, as raw lines: not by customer, and without ids and hashes."""
    w = Warehouse(spark, raw, as_of=dt.datetime(2001, 1, 1), root=str(tmp_path / "wh"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(facts, "checked_broadcast", lambda df, *a: df)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = facts.narrow_rows(spark, raw, w.dim_product, w.dim_geography, w.timeline)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        sides = [line for line in plan.splitlines() if "hashpartitioning(" in line]
        assert sum("hashpartitioning(l_" in line for line in sides) == 2  # by product, by order
        assert not {"order_line_id", "order_key", "product_key", "customer_key", "order_id"} & set(rows.columns)
        w.load_fact(str(tmp_path / "fact"))
        assert layout.disordered_partitions(spark, str(tmp_path / "fact")) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
