"""The named query catalogue: one entry per operator of the model.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
raw tables (or data Spark derives from them). ``report`` normalises output
types for engine-neutral comparison: money decimals become DOUBLE (exact
decimal sums are cast once, at the end) and DATEs become timestamps.
Reports, checks and marts read the stored tables (``Warehouse``). Entries
that exercise the write path write to a fresh folder under the shared
checkpoint directory and read the table back; the application's scratch
folder goes when it ends.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import fiscal_quarter, fiscal_year
from starloom.functions.keys import surrogate_key
from starloom.operators import calendar, forecast, gate, layout, marts, ops, quality, scd2, upsert
from starloom.operators.asof import asof_join
from starloom.operators.pit import pit_join
from starloom.operators.schemas import (DIM_CUSTOMER_DEFAULTS, DIM_CUSTOMER_SCHEMA, FACT_DEFAULTS, FACT_SCHEMA,
                                        append_conformed, conform, create_if_absent)
from starloom.operators.scd2_store import Scd2Store
from starloom.operators.stored_marts import StoredMarts
from starloom.params import BENCH_YEAR, DEFAULT_AS_OF, LOOKBACK_DAYS
from starloom.plans.warehouse import Warehouse
from starloom.session import released_shuffles, scratch_path
from starloom.sources import staging
from starloom.sources.line_store import LineStore
from starloom.sources.tables import read_raw

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

Y0, Y1 = f"{BENCH_YEAR}-01-01", f"{BENCH_YEAR}-12-31"
AS_OF = DEFAULT_AS_OF
# snapshot cut-offs merged in order by the SCD2 merge entries; the last is open
SNAPSHOT_CUTS = ["1997-01-01", "1999-01-01", None]
# damage for the entries that show what the checks find: one key in so many
DAMAGE_CUSTOMERS, DAMAGE_ORDERS = 13, 97
# initial load boundary and arrival cut for the incremental entries
INITIAL_LOAD_TO = "2001-07-01"
SECOND_LOAD_TO = "2001-07-16"
# point in time of the as-of lookup
LOOKUP_AT = "1999-01-01 00:00:00"


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def report(df: DataFrame, text_ts=("valid_to",)) -> DataFrame:
    """Engine-neutral output types. ``text_ts`` columns may hold the
    9999-12-31 open end, which pandas' nanosecond timestamps cannot hold;
    they are rendered as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in text_ts and isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir, as_of=AS_OF)


# --- staging and dimensions ---------------------------------------------------

@query("stg_orders")
def q_stg_orders(spark, sf_dir):
    return report(wh(spark, sf_dir).stg_orders)


@query("stg_customers")
def q_stg_customers(spark, sf_dir):
    return report(wh(spark, sf_dir).stg_customers)


@query("stg_products")
def q_stg_products(spark, sf_dir):
    return report(wh(spark, sf_dir).stg_products)


@query("stg_geography")
def q_stg_geography(spark, sf_dir):
    return report(wh(spark, sf_dir).src_geography)


@query("stg_events")
def q_stg_events(spark, sf_dir):
    return report(staging.stg_events(spark, sf_dir))


def damaged_orders(spark, sf_dir):
    """Raw orders, one in so many once more: a day earlier, its texts padded."""
    o = read_raw(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    again = o.where(F.col("o_orderkey") % DAMAGE_ORDERS == 0) \
        .withColumn("o_orderdate", F.col("o_orderdate") - F.expr("interval 1 day")) \
        .withColumn("o_orderstatus", F.concat(F.lit("  "), F.lower("o_orderstatus"))) \
        .withColumn("o_orderpriority", F.lit("  "))
    # and the last one twice as it is
    return o.unionByName(again).unionByName(o.where(F.col("o_orderkey") % DAMAGE_ORDERS == 1))


def damaged_customers(spark, sf_dir):
    c = read_raw(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    again = c.where(F.col("c_custkey") % DAMAGE_CUSTOMERS == 0) \
        .withColumn("c_name", F.concat(F.lit(" "), F.col("c_name"), F.lit("  "))) \
        .withColumn("c_mktsegment", F.lower("c_mktsegment"))
    return c.unionByName(again)


@query("stg_orders_cleaned")
def q_stg_orders_cleaned(spark, sf_dir):
    return staging.clean_orders(damaged_orders(spark, sf_dir))


@query("stg_customers_cleaned")
def q_stg_customers_cleaned(spark, sf_dir):
    return staging.clean_customers(damaged_customers(spark, sf_dir))


@query("dq_customers_without_order")
def q_dq_customers_without_order(spark, sf_dir):
    # every customer of the damaged share has lost its orders
    orders = read_raw(spark, sf_dir, "orders", ["o_custkey"]).where(F.col("o_custkey") % DAMAGE_CUSTOMERS != 0)
    return staging.customers_without_order(staging.clean_customers(damaged_customers(spark, sf_dir)), orders)


@query("dim_product")
def q_dim_product(spark, sf_dir):
    return report(wh(spark, sf_dir).dim_product)


@query("dim_geography")
def q_dim_geography(spark, sf_dir):
    return report(wh(spark, sf_dir).dim_geography)


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return report(wh(spark, sf_dir).dim_date)


@query("date_spine")
def q_date_spine(spark, sf_dir):
    return report(calendar.date_spine(wh(spark, sf_dir).calendar_days))


@query("dim_date_holidays")
def q_dim_date_holidays(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(calendar.dim_date(w.calendar_days, holidays=calendar.read_holiday_seed(spark)))


@query("fiscal_calendar")
def q_fiscal_calendar(spark, sf_dir):
    d = F.col("d")
    cols = [d.alias("full_date")]
    for m in (10, 4, 1):
        cols += [fiscal_year(d, m).cast("int").alias(f"fiscal_year_m{m}"),
                 fiscal_quarter(d, m).alias(f"fiscal_quarter_m{m}")]
    return report(wh(spark, sf_dir).calendar_days.select(*cols))


@query("append_rows")
def q_append_rows(spark, sf_dir):
    """The calendar written in two appends (years before and from the bench
    year), read back: equals the calendar."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "dim_date_append")
    cal = w.dim_date
    cal.filter(F.col("year") < BENCH_YEAR).write.mode("append").parquet(path)
    cal.filter(F.col("year") >= BENCH_YEAR).write.mode("append").parquet(path)
    return report(spark.read.parquet(path))


@query("scd2_history")
def q_scd2_history(spark, sf_dir):
    return report(wh(spark, sf_dir).snapshot)


@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return report(wh(spark, sf_dir).dim_customer)


@query("dim_customer_current")
def q_dim_customer_current(spark, sf_dir):
    return report(scd2.current_rows(wh(spark, sf_dir).dim_customer))


@query("customer_as_of")
def q_customer_as_of(spark, sf_dir):
    d = wh(spark, sf_dir).dim_customer
    return report(scd2.as_of_lookup(d, LOOKUP_AT).select(
        "customer_key", "customer_id", "customer_segment", "valid_from", "valid_to"))


@query("customer_history_audit")
def q_customer_history_audit(spark, sf_dir):
    d = wh(spark, sf_dir).dim_customer
    end = F.when(F.col("is_current"), F.lit(AS_OF).cast("timestamp_ntz")).otherwise(F.col("valid_to"))
    return report(d.select(
        "customer_id", "customer_segment", "city", "valid_from", "valid_to", "is_current",
        F.datediff(F.to_date(end), F.to_date("valid_from")).alias("days_in_segment"),
    ).orderBy("customer_id", "valid_from"))


# --- SCD2 merge ------------------------------------------------------------------

def _snapshots(w: Warehouse) -> list[DataFrame]:
    return [scd2.latest_per_key(w.customer_feed, before=c) for c in SNAPSHOT_CUTS]


def _merged(w: Warehouse, upto: int) -> DataFrame:
    snaps = _snapshots(w)
    dim, _ = scd2.merge_batches(scd2.empty_like_dim(w.stg_customers), snaps[:upto], as_of=AS_OF)
    return dim


@query("scd2_merge_step")
def q_scd2_merge_step(spark, sf_dir):
    return report(_merged(wh(spark, sf_dir), 3))


@query("scd2_changed")
def q_scd2_changed(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(scd2.detect_changes(_snapshots(w)[2], _merged(w, 2)))


@query("scd2_new_keys")
def q_scd2_new_keys(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(scd2.detect_changes(_snapshots(w)[2], _merged(w, 2))
                  .filter(F.col("change_type") == "new").select("customer_id", "updated_at"))


@query("scd2_changed_keys")
def q_scd2_changed_keys(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(scd2.detect_changes(_snapshots(w)[2], _merged(w, 2))
                  .filter(F.col("change_type") == "changed").select("customer_id", "customer_segment", "updated_at"))


@query("scd2_merge_generic")
def q_scd2_merge_generic(spark, sf_dir):
    """The generic merge (key and tracked columns as parameters) applying
    the whole change feed as one batch: several versions per key at once."""
    w = wh(spark, sf_dir)
    feed = w.stg_customers
    dim, _ = scd2.scd2_merge(scd2.empty_like_dim(feed), feed, natural_key=["customer_id"],
                             tracked=["customer_segment"], as_of=AS_OF)
    return report(dim)


@query("scd2_rejected")
def q_scd2_rejected(spark, sf_dir):
    """What the merge hands back instead of losing it: the second snapshot is
    delivered again, dated one day before each customer's current version and
    in another segment, after all snapshots were merged."""
    w = wh(spark, sf_dir)
    late = _snapshots(w)[1].withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 1 DAY")) \
        .withColumn("customer_segment", F.lit("Late"))
    _, rejected = scd2.scd2_merge(_merged(w, 3), late, as_of=AS_OF)
    return report(rejected)


@query("scd2_store_merge")
def q_scd2_store_merge(spark, sf_dir):
    """The snapshots merged one after the other into the stored dimension of
    which a merge writes only the buckets it changes. Equals scd2_merge_step."""
    store = Scd2Store(spark, scratch_path(spark, "dim_store"), as_of=AS_OF)
    for snapshot in _snapshots(wh(spark, sf_dir)):
        store.merge(snapshot)
    return report(store.read())


@query("create_dim_customer")
def q_create_dim_customer(spark, sf_dir):
    """The typed dimension created when absent (twice: the second is a no-op),
    then the current versions inserted without the columns that have defaults."""
    path = scratch_path(spark, "dim_customer_typed")
    for _ in range(2):
        create_if_absent(spark, path, DIM_CUSTOMER_SCHEMA)
    rows = scd2.current_rows(wh(spark, sf_dir).dim_customer).drop(*DIM_CUSTOMER_DEFAULTS)
    append_conformed(rows, path, DIM_CUSTOMER_SCHEMA, DIM_CUSTOMER_DEFAULTS, as_of=AS_OF)
    return report(spark.read.parquet(path))


# --- fact ----------------------------------------------------------------------

@query("fact_orders")
def q_fact_orders(spark, sf_dir):
    return report(wh(spark, sf_dir).fact)


@query("first_orders")
def q_first_orders(spark, sf_dir):
    return report(wh(spark, sf_dir).first_orders)


@query("pit_join_customer")
def q_pit_join_customer(spark, sf_dir):
    w = wh(spark, sf_dir)
    o = w.stg_orders.select("order_line_id", "customer_id", "order_date")
    return report(pit_join(o, w.dim_customer, take=("customer_key", "customer_segment")))


@query("asof_join_customer")
def q_asof_join_customer(spark, sf_dir):
    """The same as pit_join_customer, by carrying the last version forward."""
    w = wh(spark, sf_dir)
    o = w.stg_orders.select("order_line_id", "customer_id", "order_date")
    return report(asof_join(o, w.dim_customer, take=("customer_key", "customer_segment")))


@query("fact_measures")
def q_fact_measures(spark, sf_dir):
    return report(wh(spark, sf_dir).fact.select(
        "order_line_id", "discount_amount", "cost_of_goods", "gross_profit", "tax_amount"))


@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    w = wh(spark, sf_dir)
    parts = [
        w.stg_products.select(F.lit("product").alias("kind"), F.col("product_id").alias("natural_key"),
                              surrogate_key("product_id").alias("surrogate")),
        w.src_geography.select(F.lit("geography").alias("kind"),
                               F.concat_ws("|", "city", "state", "country").alias("natural_key"),
                               surrogate_key("city", "state", "country").alias("surrogate")),
        w.stg_customers.select(F.lit("customer_version").alias("kind"),
                               F.concat_ws("|", F.col("customer_id"), F.col("updated_at").cast("string")).alias("natural_key"),
                               surrogate_key("customer_id", "updated_at").alias("surrogate")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("scalar_suite")
def q_scalar_suite(spark, sf_dir):
    d = wh(spark, sf_dir).dim_customer
    return report(d.select(
        "customer_key",
        F.concat_ws("-", F.coalesce("customer_segment", F.lit("")), F.col("is_active").cast("string")).alias("seg_active"),
        F.coalesce(F.col("email"), F.col("full_name")).alias("contact"),
        F.col("version_number").cast("string").alias("version_text"),
        F.col("valid_from").cast("date").alias("valid_from_date"),
        F.col("lifetime_value").cast("int").alias("ltv_int"),
        F.when(F.col("is_current"), "current").otherwise("closed").alias("state_label"),
    ))


@query("lookback_window")
def q_lookback_window(spark, sf_dir):
    """Lines a run re-reads when the target holds everything up to the
    initial load date: order_date >= max(loaded) - 3 days."""
    w = wh(spark, sf_dir)
    target = w.stg_orders.filter(F.col("order_date") <= F.lit(INITIAL_LOAD_TO).cast("date")).select("order_date")
    sel = upsert.select_incremental(w.stg_orders, target)
    return report(sel.select("order_line_id", "order_date"))


def _changed_batch(w: Warehouse) -> DataFrame:
    """Lines of the last lookback window whose order is still open come back
    returned, with one unit less net revenue."""
    last = staging.stg_orders(w.spark, w.sf_dir, since=upsert.watermark(staging.days_of_lines(w.spark, w.sf_dir)))
    sel = upsert.select_incremental(last, last)
    return sel.filter(F.col("order_status") == "O").withColumn("order_status", F.lit("returned")) \
        .withColumn("net_revenue", (F.col("net_revenue") - F.expr("1.00BD")).cast("decimal(12,2)"))


@query("fact_orders_incremental")
def q_fact_orders_incremental(spark, sf_dir):
    """Initial load, two lookback runs as data arrives, then a run with
    changed lines; every run reads the raw orders of its own days only and
    upserts only the touched month partitions."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_incremental")
    w.load_fact(path, until=INITIAL_LOAD_TO)

    def merge(t, s):
        return upsert.upsert(t, s, as_of=AS_OF)

    for cut in (SECOND_LOAD_TO, None):
        since = upsert.watermark(spark.read.parquet(path), partition=layout.PARTITION_COL)
        batch = staging.stg_orders(spark, sf_dir, since=since, until=cut)
        layout.merge_into(spark, path, w.fact_for(batch), merge)
    layout.merge_into(spark, path, w.fact_for(_changed_batch(w)), merge)
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


def _order_days(spark, sf_dir, since=None, until=None) -> DataFrame:
    o = read_raw(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    day = F.to_date("o_orderdate")
    o = o if since is None else o.where(day >= F.lit(str(since)).cast("date"))
    return o if until is None else o.where(day <= F.lit(str(until)).cast("date"))


def _line_store(spark, sf_dir, until=None) -> LineStore:
    """All lines; those of orders after ``until`` wait for their order."""
    store = LineStore(spark, scratch_path(spark, "lines"))
    store.add(read_raw(spark, sf_dir, "lineitem", staging.LINE_COLS), _order_days(spark, sf_dir, until=until))
    return store


@query("fact_orders_incremental_stored_lines")
def q_fact_orders_incremental_stored_lines(spark, sf_dir):
    """The same loads with lines from the store: a run settles the waiting
    lines of its orders and reads the lines of its months."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_stored_lines")
    store = _line_store(spark, sf_dir, INITIAL_LOAD_TO)
    w.load_fact(path, until=INITIAL_LOAD_TO, lines=store.between(until=INITIAL_LOAD_TO))

    def merge(t, s):
        return upsert.upsert(t, s, as_of=AS_OF)

    for cut in (SECOND_LOAD_TO, None):
        since = upsert.watermark(spark.read.parquet(path), partition=layout.PARTITION_COL)
        store.settle(_order_days(spark, sf_dir, since, cut))
        batch = staging.stg_orders(spark, sf_dir, since=since, until=cut, lines=store.between(since, cut))
        layout.merge_into(spark, path, w.fact_for(batch), merge)
    layout.merge_into(spark, path, w.fact_for(_changed_batch(w)), merge)
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("line_store_batch_report")
def q_line_store_batch_report(spark, sf_dir):
    since = _order_days(spark, sf_dir).agg(F.date_sub(F.to_date(F.max("o_orderdate")), LOOKBACK_DAYS)).first()[0]
    return _line_store(spark, sf_dir).batch_report(since)


def _some_orders(n: int, col: str = "order_id"):
    return F.col(col).cast("long") % DAMAGE_ORDERS == n


def _merge_corrections(spark, sf_dir, kind: str, moved: F.Column) -> DataFrame:
    """The stored fact, upserted with some of its lines under another date."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, f"fact_{kind}")
    layout.write_layout(w.fact, path, "date_channel", arranged=True)
    batch = w.fact.filter(_some_orders(0)).withColumn("order_date", moved)
    layout.merge_into(spark, path, batch, lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=AS_OF))
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("merge_moved_dates")
def q_merge_moved_dates(spark, sf_dir):
    """Source corrections that move lines over a month end replace their rows."""
    return _merge_corrections(spark, sf_dir, "moved", F.add_months("order_date", 1))


def _marts_after_moves(spark, sf_dir) -> StoredMarts:
    """Stored marts of the fact, built and then kept up to date through a merge
    that moves lines over a month end and one that changes the last days."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_marts")
    layout.write_layout(w.fact, path, "date_channel", arranged=True)
    kept = StoredMarts(spark, path, scratch_path(spark, "marts")).build()
    batch = w.fact.filter(_some_orders(0)).withColumn("order_date", F.add_months("order_date", 1))
    return kept.merge(batch, lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=AS_OF))


@query("agg_daily_revenue_incremental")
def q_agg_daily_revenue_incremental(spark, sf_dir):
    return report(_marts_after_moves(spark, sf_dir).daily())


@query("agg_cohort_incremental")
def q_agg_cohort_incremental(spark, sf_dir):
    return report(_marts_after_moves(spark, sf_dir).cohort())


@query("agg_channel_perf_incremental")
def q_agg_channel_perf_incremental(spark, sf_dir):
    return report(_marts_after_moves(spark, sf_dir).channels())


@query("gated_load")
def q_gated_load(spark, sf_dir):
    """A merge whose new rows pass their checks is published."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_gated")
    layout.write_layout(w.fact, path, "date_channel", arranged=True)
    gate.gated_merge(spark, path, w.fact_for(_changed_batch(w)), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=AS_OF),
                     gate.fact_audit(_fks(w)))
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("gated_load_refused")
def q_gated_load_refused(spark, sf_dir):
    """A merge with faulty rows is refused: what the checks found, and how many
    lines the stored fact has lost or changed by it (none)."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_refused")
    layout.write_layout(w.fact, path, "date_channel", arranged=True)
    faults = {"customer_key": F.when(_some_orders(0), F.lit("missing")).otherwise(F.col("customer_key")),
              "net_revenue": F.when(_some_orders(4), (F.col("gross_revenue") + 1).cast("decimal(12,2)")).otherwise(F.col("net_revenue"))}
    batch = w.fact.filter(_some_orders(0) | _some_orders(4)).withColumns(faults)
    try:
        gate.gated_merge(spark, path, batch, lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=AS_OF), gate.fact_audit(_fks(w)))
    except gate.LoadRefused:
        pass  # the refusal is what this entry shows
    now = spark.read.parquet(path).select(*w.fact.columns)
    changed = quality.rows_lost(w.fact, now).select(F.lit("lines_changed").alias("check_name"), F.col("rows_lost").alias("failures"))
    return gate.refusals(spark, path).select("check_name", "failures").unionByName(changed)


@query("merge_undated_rows")
def q_merge_undated_rows(spark, sf_dir):
    """A first correction takes the dates of some lines away, a second changes
    one half of them: the others stay as they are."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_undated")
    none = F.lit(None).cast("date")
    layout.write_layout(w.fact.withColumn("order_date", F.when(_some_orders(0), none).otherwise(F.col("order_date"))), path, "date_channel",
                        arranged=True)
    batch = w.fact.filter(_some_orders(0) & (F.col("order_id").cast("long") % 2 == 0)).withColumn("order_date", none) \
        .withColumn("return_flag", ~F.col("return_flag"))
    layout.merge_into(spark, path, batch, lambda t, s: upsert.upsert(t, s, as_of=AS_OF))
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("upsert_all_columns")
def q_upsert_all_columns(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(upsert.upsert_apart(w.fact, w.fact_for(_changed_batch(w)), update_cols="all", as_of=AS_OF))


@query("fulfillment_update")
def q_fulfillment_update(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(upsert.apply_delivery(w.fact, staging.fulfilment_feed(spark, sf_dir), as_of=AS_OF))


@query("conform_schema")
def q_conform_schema(spark, sf_dir):
    return report(conform(wh(spark, sf_dir).fact, FACT_SCHEMA))


@query("conform_defaults")
def q_conform_defaults(spark, sf_dir):
    """Lines whose return flag and load time are missing get the defaults."""
    f = wh(spark, sf_dir).fact.drop("dw_loaded_at")
    f = f.withColumn("return_flag", F.when(~_some_orders(6), F.col("return_flag")))
    return report(conform(f, FACT_SCHEMA, defaults=FACT_DEFAULTS, as_of=AS_OF))


@query("schema_evolution_union")
def q_schema_evolution_union(spark, sf_dir):
    """Lines before the bench year in the old schema, later lines with the
    planned currency columns; unionByName fills the gap with NULLs."""
    f = wh(spark, sf_dir).fact.select("order_key", "order_date", "net_revenue")
    old = f.filter(F.year("order_date") < BENCH_YEAR)
    new = f.filter(F.year("order_date") >= BENCH_YEAR).withColumn("currency_key", F.lit("USD")) \
        .withColumn("exchange_rate", F.expr("1.000000BD").cast("decimal(12,6)"))
    return report(old.unionByName(new, allowMissingColumns=True))


# --- layout ---------------------------------------------------------------------

@query("layout_roundtrip")
def q_layout_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "fact_layout")
    layout.write_layout(wh(spark, sf_dir).fact, path, "date_channel", stored=True)
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("layout_curve_roundtrip")
def q_layout_curve_roundtrip(spark, sf_dir):
    """The fact along a curve over customer, date and channel, read back."""
    path = scratch_path(spark, "fact_curve")
    layout.write_layout(wh(spark, sf_dir).fact, path, "curve", stored=True)
    return report(spark.read.parquet(path))


@query("recluster_roundtrip")
def q_recluster_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "fact_recluster")
    layout.write_layout(wh(spark, sf_dir).fact, path, "date", arranged=True)
    layout.recluster(spark, path, layout="date_channel")
    return report(spark.read.parquet(path).drop(layout.PARTITION_COL))


@query("layout_day_customer_channel")
def q_layout_day_customer_channel(spark, sf_dir):
    """The fact in day partitions clustered by customer and channel, then
    upserted with the changed lines of the last days: only those days are
    rewritten."""
    w = wh(spark, sf_dir)
    path = scratch_path(spark, "fact_day")
    name = "day_customer_channel"
    layout.write_layout(w.fact, path, name, stored=True)
    layout.merge_into(spark, path, w.fact_for(_changed_batch(w)), lambda t, s: upsert.upsert(t, s, update_cols="all", as_of=AS_OF), name)
    return report(layout.without_partition_col(spark.read.parquet(path)))


@query("retention_delete")
def q_retention_delete(spark, sf_dir):
    """Lines that are left when the expired months have been deleted; lines
    without a date stay."""
    path = scratch_path(spark, "fact_retention")
    f = wh(spark, sf_dir).fact.select("order_key", "order_id", "order_date", "channel")
    f = f.withColumn("order_date", F.when(~_some_orders(0), F.col("order_date")))
    layout.write_layout(f, path, "date_channel")
    layout.drop_expired_partitions(spark, path, AS_OF)
    return report(spark.read.parquet(path).select("order_key", "order_date"))


@query("customer_layout_roundtrip")
def q_customer_layout_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "dim_customer_layout")
    d = wh(spark, sf_dir).dim_customer
    d.repartitionByRange("customer_id", "valid_from").sortWithinPartitions("customer_id", "valid_from").write.parquet(path)
    return report(spark.read.parquet(path))


@query("retention_filter")
def q_retention_filter(spark, sf_dir):
    f = layout.with_partition_col(wh(spark, sf_dir).fact)
    months = f.groupBy(layout.PARTITION_COL).agg(F.count(F.lit(1)).alias("order_lines"))
    return report(layout.expired_months(months, AS_OF))


@query("guarded_scan")
def q_guarded_scan(spark, sf_dir):
    return report(marts.full_range_sum(wh(spark, sf_dir).fact_between(Y0, Y1), None, None))


@query("job_log_report")
def q_job_log_report(spark, sf_dir):
    """Workload report over the job log mapped from the events table: the
    newest 50 QUERY jobs of the last day of the log."""
    return ops.job_log_report(staging.job_log_from_events(spark, sf_dir))


# --- data quality ----------------------------------------------------------------

@query("dq_orphaned_orders")
def q_dq_orphaned_orders(spark, sf_dir):
    return quality.orphaned_orders(wh(spark, sf_dir).fact)


@query("dq_revenue_errors")
def q_dq_revenue_errors(spark, sf_dir):
    return quality.revenue_errors(wh(spark, sf_dir).fact)


@query("dq_duplicate_orders")
def q_dq_duplicate_orders(spark, sf_dir):
    """The literal check on order_id: lines of one order share it, so every
    multi-line order is reported."""
    return quality.duplicate_keys(wh(spark, sf_dir).fact, "order_id")


@query("dq_duplicate_order_keys")
def q_dq_duplicate_order_keys(spark, sf_dir):
    return quality.duplicate_keys(wh(spark, sf_dir).fact, "order_key")


@query("dq_completeness_recent")
def q_dq_completeness_recent(spark, sf_dir):
    return report(quality.completeness_recent(wh(spark, sf_dir).fact, AS_OF, 3))


@query("dq_scd2_current_count")
def q_dq_scd2_current_count(spark, sf_dir):
    return quality.scd2_current_count(wh(spark, sf_dir).dim_customer)


@query("dq_scd2_current_count_strict")
def q_dq_scd2_current_count_strict(spark, sf_dir):
    return quality.scd2_current_count(_merged(wh(spark, sf_dir), 3), strict=True)


@query("scd2_version_gaps")
def q_scd2_version_gaps(spark, sf_dir):
    """Every merged version with its successor's start and the gap in
    seconds (1 s by the merge's convention, NULL for the current row)."""
    d = _merged(wh(spark, sf_dir), 3)
    return report(quality._with_next(d, "customer_id"))


@query("dq_scd2_gaps")
def q_dq_scd2_gaps(spark, sf_dir):
    return report(quality.scd2_gaps(_merged(wh(spark, sf_dir), 3)))


@query("dq_scd2_gaps_strict")
def q_dq_scd2_gaps_strict(spark, sf_dir):
    return report(quality.scd2_gaps(wh(spark, sf_dir).dim_customer, strict=True, tolerance_s=0))


@query("dq_scd2_overlaps")
def q_dq_scd2_overlaps(spark, sf_dir):
    return report(quality.scd2_overlaps(wh(spark, sf_dir).dim_customer))


@query("dq_scd2_bad_ranges")
def q_dq_scd2_bad_ranges(spark, sf_dir):
    return report(quality.scd2_bad_ranges(wh(spark, sf_dir).dim_customer))


@query("assert_scd2")
def q_assert_scd2(spark, sf_dir):
    return quality.assert_scd2(_merged(wh(spark, sf_dir), 3))


@query("assert_scd2_strict")
def q_assert_scd2_strict(spark, sf_dir):
    return quality.assert_scd2(wh(spark, sf_dir).dim_customer, strict=True)


@query("dq_orphans_all_fks")
def q_dq_orphans_all_fks(spark, sf_dir):
    w = wh(spark, sf_dir)
    return quality.orphans_all_fks(w.fact, _fks(w))


@query("dq_constraints")
def q_dq_constraints(spark, sf_dir):
    w = wh(spark, sf_dir)
    return _constraints(w.fact, w.dim_customer, w.dim_date)


def _damaged_fact(w: Warehouse) -> DataFrame:
    """The stored fact with faults of every kind in one order of DAMAGE_ORDERS each."""
    f = w.fact
    changes = {
        "customer_key": F.when(~_some_orders(0), F.col("customer_key")),
        "product_key": F.when(_some_orders(1), F.lit("missing")).otherwise(F.col("product_key")),
        "geo_key": F.when(~_some_orders(2), F.col("geo_key")),
        "date_key": F.when(_some_orders(3), F.lit(19000101)).otherwise(F.col("date_key")),
        "net_revenue": F.when(_some_orders(4), (F.col("gross_revenue") + 1).cast("decimal(12,2)")).otherwise(F.col("net_revenue")),
    }
    return f.withColumns(changes).unionByName(f.filter(_some_orders(5)))


def _damaged_dim(dim: DataFrame) -> DataFrame:
    """A dimension with faults of every kind in one customer of DAMAGE_CUSTOMERS
    each: no current row, gaps, overlaps, two current rows, empty ranges."""
    def some(n):
        return F.col("customer_id").cast("long") % DAMAGE_CUSTOMERS == n
    closed = ~F.col("is_current")
    end = F.when(some(1) & closed, F.col("valid_to") - F.expr("INTERVAL 2 DAYS")) \
        .when(some(2) & closed, F.col("valid_to") + F.expr("INTERVAL 2 DAYS")) \
        .when(some(4) & closed, F.col("valid_from")).otherwise(F.col("valid_to"))
    return dim.filter(closed | ~some(0)).withColumn("valid_to", end).unionByName(dim.filter(~closed & some(3)))


def _fks(w: Warehouse) -> dict:
    return {"customer_key": (w.dim_customer, "customer_key"), "product_key": (w.dim_product, "product_key"),
            "geo_key": (w.dim_geography, "geo_key"), "date_key": (w.dim_date, "date_key")}


def _constraints(fact: DataFrame, dim: DataFrame, dates: DataFrame) -> DataFrame:
    f = quality.constraint_violations(
        fact, "fact_orders",
        ["order_key", "customer_key", "product_key", "date_key", "order_id", "order_timestamp", "order_date"],
        "order_key")
    d = quality.constraint_violations(dim, "dim_customer",
                                      ["customer_id", "valid_from", "valid_to", "is_current"], "customer_key")
    c = quality.constraint_violations(dates, "dim_date", ["full_date"], "date_key")
    return f.unionByName(d).unionByName(c)


# what each check finds in damaged tables
DAMAGED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "dq_orphaned_orders": lambda w: quality.orphaned_orders(_damaged_fact(w)),
    "dq_revenue_errors": lambda w: quality.revenue_errors(_damaged_fact(w)),
    "dq_duplicate_order_keys": lambda w: quality.duplicate_keys(_damaged_fact(w), "order_key"),
    "dq_orphans_all_fks": lambda w: quality.orphans_all_fks(_damaged_fact(w), _fks(w)),
    "dq_constraints": lambda w: _constraints(_damaged_fact(w), _damaged_dim(w.dim_customer), w.dim_date),
    "dq_scd2_current_count": lambda w: quality.scd2_current_count(_damaged_dim(w.dim_customer)),
    "dq_scd2_current_count_strict": lambda w: quality.scd2_current_count(_damaged_dim(_merged(w, 3)), strict=True),
    "dq_scd2_gaps": lambda w: quality.scd2_gaps(_damaged_dim(_merged(w, 3))),
    "dq_scd2_gaps_strict": lambda w: quality.scd2_gaps(_damaged_dim(w.dim_customer), strict=True, tolerance_s=0),
    "dq_scd2_overlaps": lambda w: quality.scd2_overlaps(_damaged_dim(w.dim_customer)),
    "dq_scd2_bad_ranges": lambda w: quality.scd2_bad_ranges(_damaged_dim(w.dim_customer)),
    "assert_scd2": lambda w: quality.assert_scd2(_damaged_dim(_merged(w, 3))),
    "assert_scd2_strict": lambda w: quality.assert_scd2(_damaged_dim(w.dim_customer), strict=True),
}


def _register_damaged(name: str, check) -> None:
    query(f"{name}_damaged")(lambda spark, sf_dir: report(check(wh(spark, sf_dir))))


for _name, _check in DAMAGED.items():
    _register_damaged(_name, _check)


@query("dq_lines_without_order")
def q_dq_lines_without_order(spark, sf_dir):
    """Lines that staging would drop, with one order in DAMAGE_ORDERS missing."""
    li = read_raw(spark, sf_dir, "lineitem", ["l_orderkey"])
    o = read_raw(spark, sf_dir, "orders", ["o_orderkey"])
    return staging.lines_without_order(li, o.filter(F.col("o_orderkey") % DAMAGE_ORDERS != 0))


@query("predicate_suite")
def q_predicate_suite(spark, sf_dir):
    f = wh(spark, sf_dir).fact

    def n(cond, alias):
        return F.sum(cond.cast("int")).cast("long").alias(alias)
    return f.agg(
        n(F.col("geo_key").isNull(), "n_geo_null"),
        n(F.col("channel").isin("web", "app"), "n_channel_in"),
        n(~F.col("channel").isin("web", "app"), "n_channel_not_in"),
        n((F.col("channel") == "web") | F.col("return_flag"), "n_web_or_returned"),
        n((F.col("channel") == "web") & F.col("return_flag"), "n_web_and_returned"),
        n(F.col("channel") != "retail", "n_not_retail"),
        n(~F.col("return_flag").eqNullSafe(F.lit(True)), "n_not_returned_null_safe"),
    )


# --- marts and benchmark queries ----------------------------------------------------

@query("bench_top_products")
def q_bench_top_products(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(marts.top_products(w.fact_between(Y0, Y1), w.dim_product, w.dim_geography))


@query("agg_product_performance")
def q_agg_product_performance(spark, sf_dir):
    return report(wh(spark, sf_dir).agg_product_performance)


@query("bench_top_products_preagg")
def q_bench_top_products_preagg(spark, sf_dir):
    return report(marts.top_products_from_agg(wh(spark, sf_dir).agg_product_performance, BENCH_YEAR))


@query("bench_monthly_revenue")
def q_bench_monthly_revenue(spark, sf_dir):
    return report(marts.monthly_revenue(wh(spark, sf_dir).fact_between(Y0, Y1), None, None))


@query("bench_monthly_revenue_web")
def q_bench_monthly_revenue_web(spark, sf_dir):
    return report(marts.monthly_revenue(wh(spark, sf_dir).fact_between(Y0, Y1), None, None, channel="web"))


def _busiest_customer(fact: DataFrame) -> DataFrame:
    """The customer with the most lines (ties: smallest id), as a one-row
    DataFrame; a data-derived parameter for the single-customer report."""
    c = fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "customer_id").limit(1).select("customer_id")


@query("bench_customer_history")
def q_bench_customer_history(spark, sf_dir):
    f = wh(spark, sf_dir).fact_by_customer
    cid = _busiest_customer(f).first()["customer_id"]  # a literal, pushed to the clustered copy
    return report(marts.customer_history(f, cid))


@query("bench_full_year_scan")
def q_bench_full_year_scan(spark, sf_dir):
    return report(marts.full_range_sum(wh(spark, sf_dir).fact_between(Y0, Y1), None, None))


@query("agg_daily_revenue")
def q_agg_daily_revenue(spark, sf_dir):
    return report(marts.agg_daily_revenue(wh(spark, sf_dir).fact))


@query("agg_cohort")
def q_agg_cohort(spark, sf_dir):
    return report(marts.agg_cohort(wh(spark, sf_dir).fact))


@query("agg_channel_perf")
def q_agg_channel_perf(spark, sf_dir):
    return report(marts.agg_channel_perf(wh(spark, sf_dir).fact))


@query("segment_quarter_growth")
def q_segment_quarter_growth(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(marts.segment_quarter_growth(w.fact, w.dim_customer))


@query("return_rate_by_acq_channel")
def q_return_rate_by_acq_channel(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(marts.return_rate_by_acquisition(w.fact, w.dim_customer))


@query("region_vs_forecast")
def q_region_vs_forecast(spark, sf_dir):
    w = wh(spark, sf_dir)
    return report(marts.region_vs_forecast(w.fact, w.dim_geography))


def _forecast(spark, sf_dir):
    w = wh(spark, sf_dir)
    return forecast.seasonal_forecast(forecast.monthly_revenue(w.fact, w.dim_geography))


@query("region_seasonal_forecast")
def q_region_seasonal_forecast(spark, sf_dir):
    return report(_forecast(spark, sf_dir))


@query("region_vs_seasonal_forecast")
def q_region_vs_seasonal_forecast(spark, sf_dir):
    return report(forecast.region_forecast_gap(_forecast(spark, sf_dir)))


@query("new_vs_returning")
def q_new_vs_returning(spark, sf_dir):
    return report(marts.new_vs_returning(wh(spark, sf_dir).fact))


@query("segment_revenue_at_order_time")
def q_segment_revenue_at_order_time(spark, sf_dir):
    """Lines and measures by the customer's segment when ordering."""
    w = wh(spark, sf_dir)
    pre = w.fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_revenue").alias("net"),
        F.sum("discount_amount").alias("disc"), F.sum("tax_amount").alias("tax"),
        F.sum("gross_profit").alias("profit"))
    d = w.dim_customer.select("customer_key", "customer_segment")
    out = pre.join(d, "customer_key", "left").groupBy("customer_segment").agg(
        F.sum("lines").cast("long").alias("order_lines"),
        F.sum("net").cast("decimal(18,2)").alias("net_revenue"),
        F.sum("disc").cast("decimal(18,2)").alias("discount_amount"),
        F.sum("tax").cast("decimal(18,2)").alias("tax_amount"),
        F.sum("profit").cast("decimal(18,2)").alias("gross_profit"))
    return report(out)



# --- streaming ---------------------------------------------------------------------------

# arrival slices of the landing folder (order day / change day upper bounds)
STREAM_SLICES = ["1997-12-31", "1999-12-31", None]


def _arrivals(df: DataFrame, col: str):
    """``df`` in arrival slices; the first also holds rows without a date."""
    lo = None
    for hi in STREAM_SLICES:
        c, kind = F.col(col), df.schema[col].dataType
        part = df if lo is None else df.filter(c > F.lit(lo).cast(kind))
        yield part if hi is None else part.filter((c <= F.lit(hi).cast(kind)) | (c.isNull() if lo is None else F.lit(False)))
        lo = hi


def _stream_arrivals(df: DataFrame, col: str, landing: str, run) -> None:
    """Each slice lands (as many files as its plan gives) and a catch-up run of
    the stream takes it in; the stream's checkpoint knows what it has seen."""
    for part in _arrivals(df, col):
        part.write.mode("append").parquet(landing)
        run()


def _arrivals_moved(df: DataFrame, col: str, landing: str, run) -> None:
    """``_stream_arrivals`` of rows that are costly to work out: the slices are written
    aside at once, and each lands by moving its files."""
    spark, c, kind = df.sparkSession, F.col(col), df.schema[col].dataType
    first, *others = [F.lit(hi).cast(kind) for hi in STREAM_SLICES if hi is not None]
    place = F.when((c <= first) | c.isNull(), 0)
    for i, hi in enumerate(others, 1):
        place = place.when(c <= hi, i)
    aside = scratch_path(spark, "arrivals")
    with released_shuffles(spark):
        df.withColumn("_slice", place.otherwise(len(STREAM_SLICES) - 1)).write.partitionBy("_slice").parquet(aside)
    for i in range(len(STREAM_SLICES)):
        layout.move_files(spark, f"{aside}/_slice={i}", landing, prefix=f"slice{i}-")
        run()


@query("stream_fact_upsert")
def q_stream_fact_upsert(spark, sf_dir):
    """Staged lines arrive in three slices; a stream upserts each micro-batch
    into the fact. Equals the batch fact."""
    from starloom.streaming.stream import stream_fact_upsert
    w = wh(spark, sf_dir)
    landing, fact_path, ckpt = (scratch_path(spark, n) for n in ("landing_orders", "stream_fact", "stream_fact_ckpt"))
    _arrivals_moved(w.stg_orders, "order_date", landing,
                    lambda: stream_fact_upsert(spark, landing, w.stg_orders.schema, fact_path, ckpt, w.fact_for, as_of=AS_OF))
    return report(spark.read.parquet(fact_path).drop(layout.PARTITION_COL))


@query("stream_scd2_merge")
def q_stream_scd2_merge(spark, sf_dir):
    """The customer change feed arrives in three slices; a stream merges each
    micro-batch into the versioned dimension."""
    from starloom.streaming.stream import stream_scd2
    w = wh(spark, sf_dir)
    landing, base, ckpt, rejects = (scratch_path(spark, n) for n in ("landing_customers", "stream_dim", "stream_dim_ckpt", "stream_dim_rejects"))
    _stream_arrivals(w.stg_customers, "updated_at", landing,
                     lambda: stream_scd2(spark, landing, w.stg_customers.schema, base, ckpt, rejects, as_of=AS_OF))
    return report(layout.read_versioned(spark, base))


@query("stream_scd2_state")
def q_stream_scd2_state(spark, sf_dir):
    """The same arrivals, with each key's current version in the stream's state
    and an append-only version log as its output."""
    from starloom.streaming.keyed_scd2 import dimension, stream_scd2_state
    w = wh(spark, sf_dir)
    landing, log, ckpt = (scratch_path(spark, n) for n in ("landing_changes", "version_log", "version_log_ckpt"))
    _stream_arrivals(w.stg_customers, "updated_at", landing,
                     lambda: stream_scd2_state(spark, landing, w.stg_customers.schema, log, ckpt, as_of=AS_OF))
    return report(dimension(spark.read.parquet(log)))
