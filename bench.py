"""Benchmark: load the warehouse once, then time the benchmark queries.

Mirrors the modelled benchmark: the fact is written in three physical
layouts (A: unclustered, B/C: month partitions clustered by date+channel,
customer-clustered copy) and a pre-aggregate (D); each query runs against
the layout its scenario names. Prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starloom.operators import layout, marts, ops  # noqa: E402
from starloom.params import BENCH_YEAR  # noqa: E402
from starloom.plans.warehouse import Warehouse  # noqa: E402
from starloom.session import get_spark, scratch_path  # noqa: E402

Y0, Y1 = f"{BENCH_YEAR}-01-01", f"{BENCH_YEAR}-12-31"


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", cpus * 2, app_name="starloom-bench",
                      # files of a size that fits these small tables, so that layouts can be told apart
                      extra={"spark.driver.memory": "16g", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")
    w = Warehouse(spark, sf_dir, root=root)
    q, extra = {}, {}

    # --- load: staging -> dims -> fact, written in three layouts -----------
    paths = {"date_channel": w.path("fact_orders"), "customer": w.path("fact_customer"), "none": w.path("fact_none")}

    def load():
        w.dim_geography, w.dim_product, w.dim_customer, w.fact, w.fact_by_customer  # noqa: B018  each is built and stored
        layout.write_layout(w.fact, paths["none"], "none")
    _, q["load_warehouse"] = timed(load)

    # --- one copy along a curve over customer, date and channel --------------
    paths["curve"] = w.path("fact_curve")
    _, q["build_curve_copy"] = timed(lambda: layout.write_layout(w.fact, paths["curve"], "curve", files=96))
    fcv = spark.read.parquet(paths["curve"])

    dp, dg = w.dim_product, w.dim_geography
    fa = spark.read.parquet(paths["none"])
    fc = layout.read_fact(spark, paths["date_channel"], Y0, Y1)
    fcu = spark.read.parquet(paths["customer"])

    agg, q["build_agg_product_performance"] = timed(lambda: w.agg_product_performance)

    busiest = fa.groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").first()["customer_id"]

    runs = {
        "monthly_revenue_A": lambda: marts.monthly_revenue(fa, Y0, Y1).collect(),
        "monthly_revenue_B": lambda: marts.monthly_revenue(fc, Y0, Y1).collect(),
        "monthly_revenue_C_web": lambda: marts.monthly_revenue(fc, Y0, Y1, channel="web").collect(),
        "monthly_revenue_web_curve": lambda: marts.monthly_revenue(fcv, Y0, Y1, channel="web").collect(),
        "customer_history_curve": lambda: marts.customer_history(fcv, busiest).collect(),
        "customer_history_A": lambda: marts.customer_history(fa, busiest).collect(),
        "customer_history_C": lambda: marts.customer_history(fcu, busiest).collect(),
        "top_products_A": lambda: marts.top_products(fa, dp, dg, Y0, Y1).collect(),
        "top_products_C": lambda: marts.top_products(fc, dp, dg, Y0, Y1).collect(),
        "top_products_D_preagg": lambda: marts.top_products_from_agg(agg, BENCH_YEAR).collect(),
        "full_year_scan_A": lambda: marts.full_range_sum(fa, Y0, Y1).collect(),
        "full_year_scan_C": lambda: marts.full_range_sum(fc, Y0, Y1).collect(),
    }
    for name, fn in runs.items():
        fn()  # warm (file listing, codegen)
        _, q[name] = timed(fn)

    # --- share of a layout's files that hold rows of each predicate ---------
    year = F.col("order_date").between(F.lit(Y0).cast("date"), F.lit(Y1).cast("date"))
    predicates = {"year": year, "year_web": year & (F.col("channel") == "web"), "customer": F.col("customer_id") == busiest}
    for name, path in paths.items():
        for kind, cond in predicates.items():
            r = ops.files_holding(spark.read.parquet(path), cond).first()
            extra[f"files_{kind}_{name}"] = f"{r['files_hit']}/{r['files_total']}"
            extra[f"bytes_pct_{kind}_{name}"] = round(100.0 * r["bytes_hit"] / max(r["bytes_total"], 1), 1)
    rows = fa.count()
    extra |= {"fact_rows": rows, "load_rows_per_second": round(rows / q["load_warehouse"]),
              "query_seconds": round(sum(v for k, v in q.items() if not k.startswith(("load_", "build_"))), 3)}

    query_secs = {k: round(v, 3) for k, v in q.items()}
    total = round(sum(q.values()), 3)
    print(json.dumps({
        "metric": "benchmark_load_build_and_query_seconds_total",
        "value": total,
        "unit": "sec",
        "queries": query_secs,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "layout": extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
