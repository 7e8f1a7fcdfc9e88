"""DuckDB SQL for every catalogued query (the correctness oracle).

Written independently of the DataFrame code: the staging mapping, the
history builder, the merge sequence and the fact are spelled out again in
plain SQL over the raw tables. Output types are normalised the same way as
``catalog.report``: money as DOUBLE, dates as TIMESTAMP.
"""

from __future__ import annotations

import os

from starloom.params import (
    BENCH_YEAR, CHANNELS, COST_RATIO, DEFAULT_AS_OF, FORECAST_UPLIFT, KEY_NULL_MARKER,
    KEY_SEPARATOR, LOOKBACK_DAYS, MARGIN_PCT, SCD2_MAX_TS, SEGMENT_BOUNDS, SEGMENT_TOP,
    RETENTION_DAYS, SHIPPING_BASE, SHIPPING_PER_UNIT, TAX_RATE, TOP_K,
)

AS_OF = DEFAULT_AS_OF.strftime("%Y-%m-%d %H:%M:%S")
Y0, Y1 = f"{BENCH_YEAR}-01-01", f"{BENCH_YEAR}-12-31"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{KEY_NULL_MARKER}')" for c in cols)
    return f"md5(concat_ws('{KEY_SEPARATOR}', {parts}))"


def _channel_list() -> str:
    return "[" + ", ".join(f"'{c}'" for c in CHANNELS) + "]"


def _segment_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} < {b} THEN '{n}'" for b, n in SEGMENT_BOUNDS)
    return f"CASE {whens} ELSE '{SEGMENT_TOP}' END"


TRACKED = ["customer_segment", "city", "state", "country", "is_active"]
ATTRS = ("email, full_name, first_name, last_name, acquisition_channel, acquisition_date, "
         "customer_segment, lifetime_value, city, state, country, is_active")

CUST_GEO = """
cust_geo AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment,
         n.n_name || '_C' || CAST(c.c_custkey % 4 AS VARCHAR) AS city,
         n.n_name || '_S' || CAST(c.c_custkey % 2 AS VARCHAR) AS state,
         n.n_name AS country, r.r_name AS region
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LINE_ID = ("concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), "
           "CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR), strftime(l.l_shipdate, '%Y%m%d'))")

STG_ORDERS = f"""
stg_orders AS (
  SELECT {LINE_ID} AS order_line_id,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         cg.city, cg.state, cg.country,
         o.o_orderdate AS order_timestamp,
         CAST(o.o_orderdate AS DATE) AS order_date,
         ({_channel_list()})[l.l_orderkey % 4 + 1] AS channel,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(round(l.l_discount * 100) AS DECIMAL(5,2)) AS discount_pct,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS gross_revenue,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(3,2))), 2)
              AS DECIMAL(12,2)) AS net_revenue,
         CAST({SHIPPING_BASE} + {SHIPPING_PER_UNIT} * CAST(l.l_quantity AS INTEGER) AS DECIMAL(8,2)) AS shipping_cost,
         CASE WHEN l.l_returnflag = 'R' THEN 'returned' ELSE o.o_orderstatus END AS order_status,
         CAST(l.l_shipdate AS DATE) AS ship_date
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN cust_geo cg ON o.o_custkey = cg.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

STG_PRODUCTS = f"""
stg_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * {COST_RATIO}, 2) AS DECIMAL(12,2)) AS cost_price,
         CAST(p_retailprice AS DECIMAL(12,2)) AS list_price,
         CAST({MARGIN_PCT} AS DECIMAL(5,2)) AS margin_pct,
         CAST(p_size AS DECIMAL(8,2)) AS weight_kg,
         TRUE AS is_active, CAST(NULL AS DATE) AS launch_date
  FROM part)"""

SRC_GEO = """
src_geography AS (
  SELECT city, state, country, min(region) AS region, CAST(NULL AS VARCHAR) AS sub_region,
         'UTC' AS timezone, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
  FROM cust_geo GROUP BY city, state, country)"""

STG_CUSTOMERS = f"""
cust_daily AS (
  SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS day,
         sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amt
  FROM orders GROUP BY 1, 2),
cust_spend AS (
  SELECT custkey, day,
         sum(amt) OVER (PARTITION BY custkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spend,
         min(day) OVER (PARTITION BY custkey) AS first_day
  FROM cust_daily),
cust_seg AS (
  SELECT *, {_segment_case('spend')} AS segment FROM cust_spend),
cust_seg2 AS (
  SELECT *, lag(segment) OVER (PARTITION BY custkey ORDER BY day) AS prev_segment FROM cust_seg),
stg_customers AS (
  SELECT CAST(s.custkey AS VARCHAR) AS customer_id,
         lower(replace(cg.c_name, '#', '.')) || '@example.com' AS email,
         cg.c_name AS full_name, 'Customer' AS first_name, split_part(cg.c_name, '#', 2) AS last_name,
         cg.c_mktsegment AS acquisition_channel, s.first_day AS acquisition_date,
         s.segment AS customer_segment, CAST(s.spend AS DECIMAL(12,2)) AS lifetime_value,
         cg.city, cg.state, cg.country, TRUE AS is_active, CAST(s.day AS TIMESTAMP) AS updated_at
  FROM cust_seg2 s LEFT JOIN cust_geo cg ON s.custkey = cg.c_custkey
  WHERE s.prev_segment IS NULL OR s.prev_segment <> s.segment)"""

HASH_TRACKED = skey(*TRACKED)

SNAPSHOT = f"""
hist0 AS (SELECT *, {HASH_TRACKED} AS _h FROM stg_customers),
hist1 AS (SELECT *, lag(_h) OVER (PARTITION BY customer_id ORDER BY updated_at) AS _prev_h FROM hist0),
snap AS (
  SELECT customer_id, {ATTRS},
         {skey('customer_id', 'updated_at')} AS dbt_scd_id,
         updated_at AS dbt_valid_from,
         lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS dbt_valid_to,
         updated_at AS dbt_updated_at
  FROM hist1 WHERE _prev_h IS NULL OR _prev_h <> _h)"""

DIM_CUSTOMER = f"""
dim_customer AS (
  SELECT {skey('customer_id', 'dbt_valid_from')} AS customer_key, customer_id, {ATTRS},
         dbt_valid_from AS valid_from,
         coalesce(dbt_valid_to, TIMESTAMP '{SCD2_MAX_TS}') AS valid_to,
         dbt_valid_to IS NULL AS is_current,
         CAST(date_diff('day', CAST(dbt_valid_from AS DATE),
              CAST(coalesce(dbt_valid_to, TIMESTAMP '{AS_OF}') AS DATE)) AS INTEGER) AS days_active,
         CAST(row_number() OVER (PARTITION BY customer_id ORDER BY dbt_valid_from) AS INTEGER) AS version_number,
         dbt_updated_at AS dw_updated_at
  FROM snap)"""

DIM_PRODUCT = f"""
dim_product AS (
  SELECT {skey('product_id')} AS product_key, product_id, product_name, category, subcategory, brand,
         cost_price, list_price, margin_pct, weight_kg, is_active, launch_date,
         TIMESTAMP '{AS_OF}' AS dw_updated_at
  FROM stg_products)"""

DIM_GEO = f"""
dim_geography AS (
  SELECT {skey('city', 'state', 'country')} AS geo_key, city, state, country, region, sub_region,
         timezone, latitude, longitude
  FROM src_geography)"""

FIRST_ORDERS = """
first_orders AS (
  SELECT customer_id, min(order_date) AS first_order_date FROM stg_orders GROUP BY customer_id)"""


def fact_cte(source: str = "stg_orders", name: str = "fact", dim: str = "dim_customer",
             upper: str = "d.valid_to") -> str:
    """Fact assembly over ``source`` (all staged lines or a slice)."""
    return f"""
{name} AS (
  SELECT {skey('o.order_line_id')} AS order_key, o.order_line_id, d.customer_key, o.customer_id,
         p.product_key,
         CAST(year(o.order_date) * 10000 + month(o.order_date) * 100 + day(o.order_date) AS INTEGER) AS date_key,
         g.geo_key, o.order_id, o.order_timestamp, o.order_date, o.channel, o.quantity, o.unit_price,
         o.discount_pct,
         CAST(round(o.gross_revenue * o.discount_pct * 0.01, 2) AS DECIMAL(12,2)) AS discount_amount,
         o.gross_revenue, o.net_revenue,
         CAST(round(p.cost_price * o.quantity, 2) AS DECIMAL(12,2)) AS cost_of_goods,
         CAST(round(o.net_revenue - p.cost_price * o.quantity, 2) AS DECIMAL(12,2)) AS gross_profit,
         o.shipping_cost,
         CAST(round(o.net_revenue * {TAX_RATE}, 2) AS DECIMAL(8,2)) AS tax_amount,
         o.order_status = 'returned' AS return_flag,
         fo.first_order_date = o.order_date AS is_first_order,
         CAST(NULL AS INTEGER) AS fulfillment_days,
         TIMESTAMP '{AS_OF}' AS dw_loaded_at
  FROM {source} o
  LEFT JOIN {dim} d ON o.customer_id = d.customer_id
       AND CAST(o.order_date AS TIMESTAMP) >= d.valid_from AND CAST(o.order_date AS TIMESTAMP) < {upper}
  LEFT JOIN first_orders fo ON o.customer_id = fo.customer_id
  LEFT JOIN dim_product p ON o.product_id = p.product_id
  LEFT JOIN dim_geography g ON o.city = g.city AND o.state = g.state AND o.country = g.country)"""


BASE = [CUST_GEO, STG_ORDERS, STG_PRODUCTS, SRC_GEO, STG_CUSTOMERS, SNAPSHOT, DIM_CUSTOMER,
        DIM_PRODUCT, DIM_GEO, FIRST_ORDERS, fact_cte()]


def with_base(body: str, extra: list[str] | None = None) -> str:
    """Prefix ``body`` with the warehouse CTEs (DuckDB prunes unused ones)."""
    ctes = ",".join(BASE + (extra or []))
    return f"WITH {ctes}\n{body}"



def R(src: str, plain=(), dbl=(), dt=(), txt=(), where: str = "") -> str:
    """SELECT with the report types: DOUBLE money, TIMESTAMP dates, text ends."""
    cols = list(plain)
    cols += [f"CAST({c} AS DOUBLE) AS {c}" for c in dbl]
    cols += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dt]
    cols += [f"CAST({c} AS VARCHAR) AS {c}" for c in txt]
    w = f" WHERE {where}" if where else ""
    return f"SELECT {', '.join(cols)} FROM {src}{w}"


FACT_PLAIN = ["order_key", "order_line_id", "customer_key", "customer_id", "product_key", "date_key",
              "geo_key", "order_id", "order_timestamp", "channel", "quantity", "return_flag",
              "is_first_order", "fulfillment_days", "dw_loaded_at"]
FACT_DBL = ["unit_price", "discount_pct", "discount_amount", "gross_revenue", "net_revenue",
            "cost_of_goods", "gross_profit", "shipping_cost", "tax_amount"]
CUST_PLAIN = ["customer_id", "email", "full_name", "first_name", "last_name", "acquisition_channel",
              "customer_segment", "city", "state", "country", "is_active"]
DIMC_PLAIN = ["customer_key"] + CUST_PLAIN + ["valid_from", "is_current", "days_active", "version_number",
                                              "dw_updated_at"]
MERGE_PLAIN = ["customer_key"] + CUST_PLAIN + ["valid_from", "is_current", "dw_created_at", "dw_updated_at"]

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


def fact_sql(src: str = "fact", where: str = "") -> str:
    return R(src, FACT_PLAIN, FACT_DBL, ["order_date"], where=where)


# --- calendar -------------------------------------------------------------------

SEED = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "seeds", "holidays.csv")

CAL_DAYS = """
cal_bounds AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders),
cal_days AS (
  SELECT CAST(gs.generate_series AS DATE) AS d
  FROM cal_bounds, generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY) gs)"""


def _fq(m: int) -> str:
    return f"CAST(floor(((month(d) - {m} + 12) % 12) / 3) + 1 AS INTEGER)"


def _fy(m: int) -> str:
    return "year(d)" if m == 1 else f"CASE WHEN month(d) >= {m} THEN year(d) + 1 ELSE year(d) END"


CAL_COLS = f"""
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS TIMESTAMP) AS full_date,
  dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name, day(d) AS day_of_month,
  dayofyear(d) AS day_of_year, weekofyear(d) AS week_number, month(d) AS month_number,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, quarter(d) AS quarter,
  'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, year(d) AS year,
  {_fy(10)} AS fiscal_year, {_fq(10)} AS fiscal_quarter,
  dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday"""

DIM_DATE_CTE = f"""
dim_date AS (SELECT {CAL_COLS}, FALSE AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name FROM cal_days)"""

oracle("dim_date", with_base("SELECT * FROM dim_date", [CAL_DAYS, DIM_DATE_CTE]))
oracle("append_rows", ORACLE["dim_date"])
oracle("date_spine", with_base(f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS TIMESTAMP) AS full_date,
  dayofweek(d) AS day_of_week, strftime(d, '%A') AS day_name, day(d) AS day_of_month,
  dayofyear(d) AS day_of_year, weekofyear(d) AS week_number, month(d) AS month_number,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, quarter(d) AS quarter,
  'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, year(d) AS year, {_fy(10)} AS fiscal_year,
  dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  FALSE AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name
FROM cal_days""", [CAL_DAYS]))
oracle("dim_date_holidays", with_base(f"""
SELECT {CAL_COLS}, coalesce(h.is_holiday, FALSE) AS is_holiday, h.holiday_name
FROM cal_days LEFT JOIN read_csv('{SEED}', header = true,
     columns = {{'full_date': 'DATE', 'is_holiday': 'BOOLEAN', 'holiday_name': 'VARCHAR'}}) h
  ON cal_days.d = h.full_date""", [CAL_DAYS]))
oracle("fiscal_calendar", with_base(
    "SELECT CAST(d AS TIMESTAMP) AS full_date, "
    + ", ".join(f"{_fy(m)} AS fiscal_year_m{m}, {_fq(m)} AS fiscal_quarter_m{m}" for m in (10, 4, 1))
    + " FROM cal_days", [CAL_DAYS]))

# --- staging and dimensions -------------------------------------------------------

oracle("stg_orders", with_base(R("stg_orders", [
    "order_line_id", "order_id", "customer_id", "product_id", "city", "state", "country", "order_timestamp",
    "channel", "quantity", "order_status"],
    ["unit_price", "discount_pct", "gross_revenue", "net_revenue", "shipping_cost"], ["order_date"])))
oracle("stg_customers", with_base(R("stg_customers", CUST_PLAIN + ["updated_at"], ["lifetime_value"],
                                    ["acquisition_date"])))
oracle("stg_products", with_base(R("stg_products", [
    "product_id", "product_name", "category", "subcategory", "brand", "is_active"],
    ["cost_price", "list_price", "margin_pct", "weight_kg"], ["launch_date"])))
GEO_COLS = ["city", "state", "country", "region", "sub_region", "timezone", "latitude", "longitude"]
oracle("stg_geography", with_base(R("src_geography", GEO_COLS)))
oracle("dim_geography", with_base(R("dim_geography", ["geo_key"] + GEO_COLS)))
oracle("dim_product", with_base(R("dim_product", [
    "product_key", "product_id", "product_name", "category", "subcategory", "brand", "is_active", "dw_updated_at"],
    ["cost_price", "list_price", "margin_pct", "weight_kg"], ["launch_date"])))

oracle("scd2_history", with_base(R("snap", CUST_PLAIN + ["dbt_scd_id", "dbt_valid_from", "dbt_valid_to",
                                                         "dbt_updated_at"], ["lifetime_value"], ["acquisition_date"])))
oracle("dim_customer", with_base(R("dim_customer", DIMC_PLAIN, ["lifetime_value"], ["acquisition_date"], ["valid_to"])))
oracle("customer_layout_roundtrip", ORACLE["dim_customer"])
oracle("dim_customer_current", with_base(R("dim_customer", DIMC_PLAIN, ["lifetime_value"], ["acquisition_date"],
                                           ["valid_to"], where="is_current")))
LOOKUP_AT = "1999-01-01 00:00:00"
oracle("customer_as_of", with_base(R(
    "dim_customer", ["customer_key", "customer_id", "customer_segment", "valid_from"], txt=["valid_to"],
    where=f"valid_from <= TIMESTAMP '{LOOKUP_AT}' AND TIMESTAMP '{LOOKUP_AT}' < valid_to")))
oracle("customer_history_audit", with_base(f"""
SELECT customer_id, customer_segment, city, valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current,
       CAST(date_diff('day', CAST(valid_from AS DATE),
            CAST(CASE WHEN is_current THEN TIMESTAMP '{AS_OF}' ELSE valid_to END AS DATE)) AS INTEGER)
         AS days_in_segment
FROM dim_customer"""))

# --- SCD2 merge: snapshots merged in order == history over their union -------------

# the third snapshot is open
SNAPS = """
snap_cuts AS (SELECT * FROM (VALUES (1, TIMESTAMP '1997-01-01 00:00:00'), (2, TIMESTAMP '1999-01-01 00:00:00'),
                                    (3, CAST(NULL AS TIMESTAMP))) t(k, cut)),
snaps AS (
  SELECT k AS snap_no, f.*
  FROM snap_cuts JOIN stg_customers f ON snap_cuts.cut IS NULL OR f.updated_at < snap_cuts.cut
  QUALIFY row_number() OVER (PARTITION BY k, f.customer_id ORDER BY f.updated_at DESC) = 1)"""


def merged_cte(name: str, upto: int, tracked=None, src: str | None = None) -> str:
    h = skey(*(tracked or TRACKED))
    rows = src or f"(SELECT DISTINCT customer_id, {ATTRS}, updated_at FROM snaps WHERE snap_no <= {upto})"
    w = "OVER (PARTITION BY customer_id ORDER BY updated_at)"
    return f"""
{name}_h AS (SELECT *, {h} AS _h, lag({h}) {w} AS _p FROM {rows} r),
{name} AS (
  SELECT {skey('customer_id', 'updated_at')} AS customer_key, customer_id, {ATTRS},
         updated_at AS valid_from,
         coalesce(lead(updated_at) {w} - INTERVAL 1 SECOND, TIMESTAMP '{SCD2_MAX_TS}') AS valid_to,
         lead(updated_at) {w} IS NULL AS is_current,
         TIMESTAMP '{AS_OF}' AS dw_created_at, TIMESTAMP '{AS_OF}' AS dw_updated_at
  FROM {name}_h WHERE _p IS NULL OR _p <> _h)"""


M3 = [SNAPS, merged_cte("m3", 3)]
MERGE_REPORT = dict(plain=MERGE_PLAIN, dbl=["lifetime_value"], dt=["acquisition_date"], txt=["valid_to"])
oracle("scd2_merge_step", with_base(R("m3", **MERGE_REPORT), M3))
oracle("scd2_store_merge", ORACLE["scd2_merge_step"])
oracle("scd2_merge_generic", with_base(R("mg", **MERGE_REPORT),
                                       [merged_cte("mg", 0, ["customer_segment"], "stg_customers")]))

CHANGED = SNAPS + f""",
m2_cur AS (
  SELECT customer_id, {HASH_TRACKED} AS _h FROM snaps WHERE snap_no <= 2
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1),
changed AS (
  SELECT i.customer_id, {', '.join('i.' + a.strip() for a in ATTRS.split(','))}, i.updated_at,
         CASE WHEN c.customer_id IS NULL THEN 'new' ELSE 'changed' END AS change_type
  FROM (SELECT * FROM snaps WHERE snap_no = 3) i LEFT JOIN m2_cur c ON i.customer_id = c.customer_id
  WHERE c.customer_id IS NULL OR {skey(*['i.' + t for t in TRACKED])} <> c._h)"""
oracle("scd2_changed", with_base(R("changed", CUST_PLAIN + ["updated_at", "change_type"], ["lifetime_value"],
                                   ["acquisition_date"]), [CHANGED]))
oracle("scd2_new_keys", with_base(R("changed", ["customer_id", "updated_at"], where="change_type = 'new'"),
                                  [CHANGED]))
oracle("scd2_changed_keys", with_base(R("changed", ["customer_id", "customer_segment", "updated_at"],
                                        where="change_type = 'changed'"), [CHANGED]))

oracle("scd2_rejected", with_base(f"""
SELECT {', '.join(c for c in CUST_PLAIN if c != 'customer_segment')}, 'Late' AS customer_segment,
       CAST(lifetime_value AS DOUBLE) AS lifetime_value, CAST(acquisition_date AS TIMESTAMP) AS acquisition_date,
       updated_at - INTERVAL 1 DAY AS valid_from
FROM snaps WHERE snap_no = 2""", [SNAPS]))
oracle("create_dim_customer", with_base(f"""
SELECT customer_key, {', '.join(CUST_PLAIN)}, valid_from, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
       CAST(acquisition_date AS TIMESTAMP) AS acquisition_date, '9999-12-31 23:59:59' AS valid_to, TRUE AS is_current,
       TIMESTAMP '{AS_OF}' AS dw_created_at, TIMESTAMP '{AS_OF}' AS dw_updated_at
FROM dim_customer WHERE is_current"""))

# --- fact and the write paths ------------------------------------------------------

oracle("fact_orders", with_base(fact_sql()))
for _k in ("conform_schema", "layout_roundtrip", "recluster_roundtrip"):
    oracle(_k, ORACLE["fact_orders"])


def some_orders(n: int) -> str:
    """The orders that a damaged or corrected fact has changed: one in 97."""
    return f"CAST(order_id AS BIGINT) % 97 = {n}"


def altered(changes: str, src: str = "fact") -> str:
    return f"(SELECT * REPLACE ({changes}) FROM {src}) x"


oracle("conform_defaults", with_base(fact_sql(altered(
    f"CASE WHEN {some_orders(6)} THEN FALSE ELSE return_flag END AS return_flag"))))
MOVED = altered(
    f"CASE WHEN {some_orders(0)} THEN CAST(order_date + INTERVAL 1 MONTH AS DATE) ELSE order_date END AS order_date")
oracle("layout_curve_roundtrip", ORACLE["fact_orders"])
oracle("merge_moved_dates", with_base(fact_sql(altered(
    f"CASE WHEN {some_orders(0)} THEN CAST(order_date + INTERVAL 1 MONTH AS DATE) ELSE order_date END AS order_date"))))
_half = f"{some_orders(0)} AND CAST(order_id AS BIGINT) % 2 = 0"
oracle("merge_undated_rows", with_base(fact_sql(altered(
    f"CASE WHEN {some_orders(0)} THEN NULL ELSE order_date END AS order_date, "
    f"CASE WHEN {_half} THEN NOT return_flag ELSE return_flag END AS return_flag"))))
oracle("retention_delete", with_base(f"""
SELECT order_key, CAST(CASE WHEN {some_orders(0)} THEN NULL ELSE order_date END AS TIMESTAMP) AS order_date FROM fact
WHERE {some_orders(0)} OR last_day(order_date) >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - {RETENTION_DAYS}"""))
oracle("first_orders", with_base(R("first_orders", ["customer_id"], dt=["first_order_date"])))
oracle("pit_join_customer", with_base("""
SELECT o.order_line_id, o.customer_id, CAST(o.order_date AS TIMESTAMP) AS order_date, d.customer_key,
       d.customer_segment
FROM stg_orders o LEFT JOIN dim_customer d ON o.customer_id = d.customer_id
  AND CAST(o.order_date AS TIMESTAMP) >= d.valid_from AND CAST(o.order_date AS TIMESTAMP) < d.valid_to"""))
oracle("fact_measures", with_base(R("fact", ["order_line_id"],
                                    ["discount_amount", "cost_of_goods", "gross_profit", "tax_amount"])))
oracle("surrogate_keys", with_base(f"""
SELECT 'product' AS kind, product_id AS natural_key, {skey('product_id')} AS surrogate FROM stg_products
UNION ALL
SELECT 'geography', concat_ws('|', city, state, country), {skey('city', 'state', 'country')} FROM src_geography
UNION ALL
SELECT 'customer_version', concat_ws('|', customer_id, CAST(updated_at AS VARCHAR)),
       {skey('customer_id', 'updated_at')} FROM stg_customers"""))
oracle("scalar_suite", with_base("""
SELECT customer_key,
       concat_ws('-', coalesce(customer_segment, ''), CAST(is_active AS VARCHAR)) AS seg_active,
       coalesce(email, full_name) AS contact,
       CAST(version_number AS VARCHAR) AS version_text,
       CAST(CAST(valid_from AS DATE) AS TIMESTAMP) AS valid_from_date,
       CAST(trunc(lifetime_value) AS INTEGER) AS ltv_int,
       CASE WHEN is_current THEN 'current' ELSE 'closed' END AS state_label
FROM dim_customer"""))

INITIAL_LOAD_TO = "2001-07-01"
oracle("lookback_window", with_base(f"""
SELECT order_line_id, CAST(order_date AS TIMESTAMP) AS order_date FROM stg_orders
WHERE order_date >= (SELECT max(order_date) FROM stg_orders WHERE order_date <= DATE '{INITIAL_LOAD_TO}') - {LOOKBACK_DAYS}"""))

CHG = f"""
chg AS (
  SELECT * REPLACE ('returned' AS order_status,
                    CAST(net_revenue - 1.00 AS DECIMAL(12,2)) AS net_revenue)
  FROM stg_orders
  WHERE order_date >= (SELECT max(order_date) FROM stg_orders) - {LOOKBACK_DAYS} AND order_status = 'O'),
stg_mod AS (
  SELECT * FROM stg_orders WHERE order_line_id NOT IN (SELECT order_line_id FROM chg)
  UNION ALL SELECT * FROM chg),""" + fact_cte("stg_mod", "fact_mod")
oracle("upsert_all_columns", with_base(fact_sql("fact_mod"), [CHG]))
oracle("layout_day_customer_channel", ORACLE["upsert_all_columns"])
oracle("fact_orders_incremental", with_base(f"""
SELECT {', '.join(c for c in FACT_PLAIN if c != 'return_flag')},
       CAST(f.order_date AS TIMESTAMP) AS order_date,
       {', '.join(f'CAST(f.{c} AS DOUBLE) AS {c}' for c in FACT_DBL if c not in ('net_revenue', 'gross_profit'))},
       coalesce(m.return_flag, f.return_flag) AS return_flag,
       CAST(coalesce(m.net_revenue, f.net_revenue) AS DOUBLE) AS net_revenue,
       CAST(coalesce(m.gross_profit, f.gross_profit) AS DOUBLE) AS gross_profit
FROM fact f LEFT JOIN (SELECT order_key AS mk, return_flag, net_revenue, gross_profit FROM fact_mod
                       WHERE order_line_id IN (SELECT order_line_id FROM chg)) m ON f.order_key = m.mk""", [CHG]))
oracle("fact_orders_incremental_stored_lines", ORACLE["fact_orders_incremental"])
oracle("line_store_batch_report", """
WITH dated AS (SELECT CAST(o_orderdate AS DATE) AS day FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
since AS (SELECT CAST(max(CAST(o_orderdate AS DATE)) - INTERVAL 3 DAY AS DATE) AS day FROM orders)
SELECT count(*) AS lines, count(*) FILTER (WHERE d.day >= date_trunc('month', s.day)) AS lines_in_months,
       count(*) FILTER (WHERE d.day >= s.day) AS lines_in_batch
FROM dated d, since s""")

oracle("fulfillment_update", with_base(f"""
SELECT {', '.join(c for c in FACT_PLAIN if c != 'fulfillment_days')},
       CAST(f.order_date AS TIMESTAMP) AS order_date,
       {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FACT_DBL)},
       CAST(date_diff('day', f.order_date, dl.delivered) AS INTEGER) AS fulfillment_days
FROM fact f LEFT JOIN (SELECT {LINE_ID} AS lid, CAST(l.l_shipdate AS DATE) AS delivered FROM lineitem l) dl
  ON f.order_line_id = dl.lid"""))
oracle("schema_evolution_union", with_base(f"""
SELECT order_key, CAST(order_date AS TIMESTAMP) AS order_date, CAST(net_revenue AS DOUBLE) AS net_revenue,
       CASE WHEN year(order_date) >= {BENCH_YEAR} THEN 'USD' END AS currency_key,
       CASE WHEN year(order_date) >= {BENCH_YEAR} THEN 1.0 END AS exchange_rate
FROM fact"""))
oracle("retention_filter", with_base(f"""
SELECT CAST(m AS TIMESTAMP) AS order_month, count(*) AS order_lines,
       last_day(m) < CAST(TIMESTAMP '{AS_OF}' AS DATE) - {RETENTION_DAYS} AS expired
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS m FROM fact) GROUP BY m"""))
FULL_SUM = f"""
SELECT CAST(CAST(sum(net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS revenue, count(*) AS order_lines
FROM fact WHERE order_date BETWEEN DATE '{Y0}' AND DATE '{Y1}'"""
oracle("guarded_scan", with_base(FULL_SUM))
oracle("bench_full_year_scan", with_base(FULL_SUM))

# --- data quality -----------------------------------------------------------------------

oracle("dq_orphaned_orders", with_base("SELECT count(*) AS orphaned_orders FROM fact WHERE customer_key IS NULL"))
oracle("dq_revenue_errors", with_base("SELECT count(*) AS revenue_errors FROM fact WHERE net_revenue > gross_revenue"))
oracle("dq_duplicate_orders", with_base("SELECT order_id, count(*) AS cnt FROM fact GROUP BY 1 HAVING count(*) > 1"))
oracle("dq_duplicate_order_keys", with_base(
    "SELECT order_key, count(*) AS cnt FROM fact GROUP BY 1 HAVING count(*) > 1"))
oracle("dq_completeness_recent", with_base(f"""
SELECT CAST(order_date AS TIMESTAMP) AS order_date, count(*) AS order_count FROM fact
WHERE order_date >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - 3 GROUP BY 1 ORDER BY 1 DESC"""))
oracle("dq_scd2_current_count", with_base(
    "SELECT customer_id, count(*) AS current_row_count FROM dim_customer WHERE is_current GROUP BY 1 "
    "HAVING count(*) <> 1"))
oracle("dq_scd2_current_count_strict", with_base(
    "SELECT customer_id, CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS current_row_count FROM m3 "
    "GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1", M3))


def with_next(src: str, where: str = "") -> str:
    w = "OVER (PARTITION BY customer_id ORDER BY valid_from)"
    wh = f" WHERE {where}" if where else ""
    return f"""(SELECT customer_id, valid_from, valid_to, is_current, lead(valid_from) {w} AS next_valid_from,
       CAST(floor(epoch(lead(valid_from) {w})) - floor(epoch(valid_to)) AS BIGINT) AS gap_seconds
FROM {src}{wh}) x"""


NEXT_COLS = dict(plain=["customer_id", "valid_from", "is_current", "next_valid_from", "gap_seconds"], txt=["valid_to"])
oracle("scd2_version_gaps", with_base(R(with_next("m3"), **NEXT_COLS), M3))
oracle("dq_scd2_gaps", with_base(R(with_next("m3", "NOT is_current"), **NEXT_COLS, where="gap_seconds > 1"), M3))
oracle("dq_scd2_gaps_strict", with_base(R(with_next("dim_customer"), **NEXT_COLS, where="gap_seconds > 0")))
oracle("dq_scd2_overlaps", with_base(R(with_next("dim_customer"), **NEXT_COLS, where="gap_seconds < 0")))
oracle("dq_scd2_bad_ranges", with_base(R("dim_customer", DIMC_PLAIN, ["lifetime_value"], ["acquisition_date"],
                                         ["valid_to"], where="valid_from >= valid_to")))


def assert_sql(src: str, strict: bool) -> str:
    if strict:
        cur = (f"SELECT customer_id FROM {src} GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1")
        gaps = f"SELECT customer_id FROM {with_next(src)} WHERE gap_seconds > 1"
    else:
        cur = f"SELECT customer_id FROM {src} WHERE is_current GROUP BY 1 HAVING count(*) <> 1"
        gaps = f"SELECT customer_id FROM {with_next(src, 'NOT is_current')} WHERE gap_seconds > 1"
    parts = [
        f"SELECT customer_id, 'multiple_current_records' AS issue FROM ({cur})",
        f"SELECT customer_id, 'date_gap_found' AS issue FROM ({gaps})",
        f"SELECT customer_id, 'invalid_date_range' AS issue FROM {src} WHERE valid_from >= valid_to",
    ]
    if strict:
        parts.append(f"SELECT customer_id, 'overlapping_versions' AS issue FROM {with_next(src)} WHERE gap_seconds < 0")
    return "\nUNION ALL\n".join(parts)


oracle("assert_scd2", with_base(assert_sql("m3", False), M3))
oracle("assert_scd2_strict", with_base(assert_sql("dim_customer", True)))

oracle("dq_orphans_all_fks", with_base("\nUNION ALL\n".join(
    f"SELECT '{fk}' AS foreign_key, count(*) AS orphans FROM fact f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{fk} = f.{fk})"
    for fk, dim in [("customer_key", "dim_customer"), ("product_key", "dim_product"),
                    ("geo_key", "dim_geography"), ("date_key", "dim_date")]), [CAL_DAYS, DIM_DATE_CTE]))


def constraints_sql(table: str, src: str, not_null: list[str], pk: str) -> list[str]:
    out = [f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
           f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {src}" for c in not_null]
    out.append(f"SELECT '{table}', 'primary_key', '{pk}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
               f"FROM (SELECT count(*) AS n FROM {src} GROUP BY {pk} HAVING count(*) > 1)")
    return out


oracle("dq_constraints", with_base("\nUNION ALL\n".join(
    constraints_sql("fact_orders", "fact", ["order_key", "customer_key", "product_key", "date_key", "order_id",
                                            "order_timestamp", "order_date"], "order_key")
    + constraints_sql("dim_customer", "dim_customer", ["customer_id", "valid_from", "valid_to", "is_current"],
                      "customer_key")
    + constraints_sql("dim_date", "dim_date", ["full_date"], "date_key")), [CAL_DAYS, DIM_DATE_CTE]))

# --- the same checks over damaged tables ---------------------------------------------------

DAMAGED_FACT = f"""
bad_fact AS (
  SELECT * REPLACE (
    CASE WHEN {some_orders(0)} THEN NULL ELSE customer_key END AS customer_key,
    CASE WHEN {some_orders(1)} THEN 'missing' ELSE product_key END AS product_key,
    CASE WHEN {some_orders(2)} THEN NULL ELSE geo_key END AS geo_key,
    CASE WHEN {some_orders(3)} THEN 19000101 ELSE date_key END AS date_key,
    CASE WHEN {some_orders(4)} THEN gross_revenue + 1 ELSE net_revenue END AS net_revenue)
  FROM fact
  UNION ALL SELECT * FROM fact WHERE {some_orders(5)})"""


def damaged_dim(src: str) -> str:
    def some(n):
        return f"CAST(customer_id AS BIGINT) % 13 = {n}"
    return f"""
bad_dim AS (
  SELECT * REPLACE (
    CASE WHEN {some(1)} AND NOT is_current THEN valid_to - INTERVAL 2 DAYS
         WHEN {some(2)} AND NOT is_current THEN valid_to + INTERVAL 2 DAYS
         WHEN {some(4)} AND NOT is_current THEN valid_from ELSE valid_to END AS valid_to)
  FROM {src} WHERE NOT is_current OR NOT {some(0)}
  UNION ALL SELECT * FROM {src} WHERE is_current AND {some(3)})"""


_BAD, _BAD3 = [DAMAGED_FACT, damaged_dim("dim_customer")], M3 + [damaged_dim("m3")]
oracle("dq_orphaned_orders_damaged", with_base("SELECT count(*) AS orphaned_orders FROM bad_fact WHERE customer_key IS NULL", _BAD))
oracle("dq_revenue_errors_damaged", with_base("SELECT count(*) AS revenue_errors FROM bad_fact WHERE net_revenue > gross_revenue", _BAD))
oracle("dq_duplicate_order_keys_damaged", with_base(
    "SELECT order_key, count(*) AS cnt FROM bad_fact GROUP BY 1 HAVING count(*) > 1", _BAD))
oracle("dq_orphans_all_fks_damaged", with_base("\nUNION ALL\n".join(
    f"SELECT '{fk}' AS foreign_key, count(*) AS orphans FROM bad_fact f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{fk} = f.{fk})"
    for fk, dim in [("customer_key", "dim_customer"), ("product_key", "dim_product"),
                    ("geo_key", "dim_geography"), ("date_key", "dim_date")]), [CAL_DAYS, DIM_DATE_CTE, *_BAD]))
oracle("dq_constraints_damaged", with_base("\nUNION ALL\n".join(
    constraints_sql("fact_orders", "bad_fact", ["order_key", "customer_key", "product_key", "date_key", "order_id",
                                                "order_timestamp", "order_date"], "order_key")
    + constraints_sql("dim_customer", "bad_dim", ["customer_id", "valid_from", "valid_to", "is_current"], "customer_key")
    + constraints_sql("dim_date", "dim_date", ["full_date"], "date_key")), [CAL_DAYS, DIM_DATE_CTE, *_BAD]))
oracle("dq_scd2_current_count_damaged", with_base(
    "SELECT customer_id, count(*) AS current_row_count FROM bad_dim WHERE is_current GROUP BY 1 HAVING count(*) <> 1", _BAD))
oracle("dq_scd2_current_count_strict_damaged", with_base(
    "SELECT customer_id, CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS current_row_count FROM bad_dim "
    "GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1", _BAD3))
oracle("dq_scd2_gaps_damaged", with_base(R(with_next("bad_dim", "NOT is_current"), **NEXT_COLS, where="gap_seconds > 1"), _BAD3))
oracle("dq_scd2_gaps_strict_damaged", with_base(R(with_next("bad_dim"), **NEXT_COLS, where="gap_seconds > 0"), _BAD))
oracle("dq_scd2_overlaps_damaged", with_base(R(with_next("bad_dim"), **NEXT_COLS, where="gap_seconds < 0"), _BAD))
oracle("dq_scd2_bad_ranges_damaged", with_base(R("bad_dim", DIMC_PLAIN, ["lifetime_value"], ["acquisition_date"],
                                                 ["valid_to"], where="valid_from >= valid_to"), _BAD))
oracle("assert_scd2_damaged", with_base(assert_sql("bad_dim", False), _BAD3))
oracle("assert_scd2_strict_damaged", with_base(assert_sql("bad_dim", True), _BAD))
oracle("dq_lines_without_order", """
SELECT l_orderkey, count(*) AS order_lines FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderkey % 97 <> 0)
GROUP BY l_orderkey""")

oracle("predicate_suite", with_base("""
SELECT CAST(count(*) FILTER (WHERE geo_key IS NULL) AS BIGINT) AS n_geo_null,
       CAST(count(*) FILTER (WHERE channel IN ('web', 'app')) AS BIGINT) AS n_channel_in,
       CAST(count(*) FILTER (WHERE channel NOT IN ('web', 'app')) AS BIGINT) AS n_channel_not_in,
       CAST(count(*) FILTER (WHERE channel = 'web' OR return_flag) AS BIGINT) AS n_web_or_returned,
       CAST(count(*) FILTER (WHERE channel = 'web' AND return_flag) AS BIGINT) AS n_web_and_returned,
       CAST(count(*) FILTER (WHERE channel <> 'retail') AS BIGINT) AS n_not_retail,
       CAST(count(*) FILTER (WHERE NOT (return_flag IS NOT DISTINCT FROM TRUE)) AS BIGINT) AS n_not_returned_null_safe
FROM fact"""))

# --- marts and benchmark queries ------------------------------------------------------------

TOP = f"""
SELECT g.region, p.category, p.product_name,
       CAST(CAST(sum(f.net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
       CAST(sum(f.quantity) AS BIGINT) AS units
FROM fact f
JOIN dim_product p ON f.product_key = p.product_key
JOIN dim_geography g ON f.geo_key = g.geo_key
WHERE f.order_date BETWEEN DATE '{Y0}' AND DATE '{Y1}'
GROUP BY 1, 2, 3
ORDER BY revenue DESC, g.region, p.category, p.product_name
LIMIT {TOP_K}"""
oracle("bench_top_products", with_base(TOP))
oracle("bench_top_products_preagg", with_base(TOP))
oracle("agg_product_performance", with_base("""
SELECT year(f.order_date) AS year, g.region, p.category, p.product_name,
       CAST(CAST(sum(f.net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(sum(f.quantity) AS BIGINT) AS units_sold
FROM fact f JOIN dim_product p ON f.product_key = p.product_key JOIN dim_geography g ON f.geo_key = g.geo_key
GROUP BY 1, 2, 3, 4"""))


def monthly(channel: str | None) -> str:
    extra = f" AND channel = '{channel}'" if channel else ""
    return f"""
SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS month, channel,
       CAST(CAST(sum(net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS revenue
FROM fact WHERE order_date BETWEEN DATE '{Y0}' AND DATE '{Y1}'{extra}
GROUP BY 1, 2 ORDER BY 1, 2"""


oracle("bench_monthly_revenue", with_base(monthly(None)))
oracle("bench_monthly_revenue_web", with_base(monthly("web")))
oracle("bench_customer_history", with_base("""
SELECT CAST(order_date AS TIMESTAMP) AS order_date, order_id, order_line_id,
       CAST(net_revenue AS DOUBLE) AS net_revenue, return_flag
FROM fact
WHERE customer_id = (SELECT customer_id FROM fact GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1)
ORDER BY order_date, order_line_id"""))
oracle("agg_daily_revenue", with_base("""
SELECT CAST(order_date AS TIMESTAMP) AS order_date, channel, count(DISTINCT order_id) AS orders,
       count(*) AS order_lines, CAST(sum(quantity) AS BIGINT) AS units,
       CAST(CAST(sum(gross_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue,
       CAST(CAST(sum(net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(gross_profit) AS DECIMAL(18,2)) AS DOUBLE) AS gross_profit,
       CAST(sum(CAST(return_flag AS INTEGER)) AS BIGINT) AS returns
FROM fact GROUP BY 1, 2"""))
oracle("agg_cohort", with_base("""
SELECT CAST(c.cohort_month AS TIMESTAMP) AS cohort_month,
       CAST((year(p.order_month) - year(c.cohort_month)) * 12 + month(p.order_month) - month(c.cohort_month)
            AS INTEGER) AS months_since,
       count(*) AS customers, CAST(CAST(sum(p.net) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue
FROM (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS order_month, sum(net_revenue) AS net
      FROM fact GROUP BY 1, 2) p
JOIN (SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month
      FROM fact GROUP BY 1) c ON p.customer_id = c.customer_id
GROUP BY 1, 2"""))
oracle("agg_channel_perf", with_base("""
SELECT channel, orders, order_lines, CAST(revenue AS DOUBLE) AS revenue, returns,
       CAST(returns AS DOUBLE) / order_lines AS return_rate, CAST(revenue AS DOUBLE) / orders AS avg_order_value
FROM (SELECT channel, count(DISTINCT order_id) AS orders, count(*) AS order_lines,
             CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue,
             CAST(sum(CAST(return_flag AS INTEGER)) AS BIGINT) AS returns
      FROM fact GROUP BY 1)"""))
for _k in ("agg_daily_revenue", "agg_cohort", "agg_channel_perf"):
    # the same marts over the fact with its moved lines
    oracle(f"{_k}_incremental", ORACLE[_k].replace("FROM fact GROUP", f"FROM {MOVED} GROUP"))
oracle("asof_join_customer", ORACLE["pit_join_customer"])
oracle("gated_load", ORACLE["upsert_all_columns"])
oracle("gated_load_refused", with_base("\nUNION ALL\n".join(
    [f"SELECT '{c}' AS check_name, count(*) AS failures FROM fact WHERE {some_orders(n)} HAVING count(*) > 0"
     for c, n in [("orphans_customer_key", 0), ("revenue_errors", 4)]]
    + ["SELECT 'lines_changed' AS check_name, 0 AS failures"])))
oracle("segment_quarter_growth", with_base("""
SELECT CAST(quarter_start AS TIMESTAMP) AS quarter_start, customer_segment, CAST(revenue AS DOUBLE) AS revenue,
       CAST(lag(revenue) OVER (PARTITION BY customer_segment ORDER BY quarter_start) AS DOUBLE) AS prev_revenue,
       CAST(CAST(revenue - lag(revenue) OVER (PARTITION BY customer_segment ORDER BY quarter_start)
            AS DECIMAL(18,2)) AS DOUBLE) AS growth
FROM (SELECT CAST(date_trunc('quarter', f.order_date) AS DATE) AS quarter_start,
             coalesce(d.customer_segment, '(unknown)') AS customer_segment,
             CAST(sum(f.net_revenue) AS DECIMAL(18,2)) AS revenue
      FROM fact f LEFT JOIN dim_customer d ON f.customer_key = d.customer_key GROUP BY 1, 2)"""))
oracle("return_rate_by_acq_channel", with_base("""
SELECT acquisition_channel, order_lines, returns, CAST(returns AS DOUBLE) / order_lines AS return_rate
FROM (SELECT coalesce(d.acquisition_channel, '(unknown)') AS acquisition_channel, count(*) AS order_lines, CAST(sum(CAST(f.return_flag AS INTEGER)) AS BIGINT) AS returns
      FROM fact f LEFT JOIN dim_customer d ON f.customer_key = d.customer_key GROUP BY 1)"""))
oracle("region_vs_forecast", with_base(f"""
SELECT region, year, CAST(revenue AS DOUBLE) AS revenue, CAST(forecast AS DOUBLE) AS forecast,
       CAST(CAST(revenue - forecast AS DECIMAL(18,2)) AS DOUBLE) AS variance,
       CASE WHEN forecast IS NULL THEN NULL WHEN revenue < forecast THEN 'under' ELSE 'on_or_above' END AS status
FROM (SELECT region, year, revenue,
             CAST(round(lag(revenue) OVER (PARTITION BY region ORDER BY year) * {FORECAST_UPLIFT}, 2)
                  AS DECIMAL(18,2)) AS forecast
      FROM (SELECT coalesce(g.region, '(unknown)') AS region, year(f.order_date) AS year, CAST(sum(f.net_revenue) AS DECIMAL(18,2)) AS revenue
            FROM fact f LEFT JOIN dim_geography g ON f.geo_key = g.geo_key GROUP BY 1, 2))"""))
SMOOTHED = """
months AS (
  SELECT coalesce(g.region, '(unknown)') AS region, CAST(date_trunc('month', f.order_date) AS DATE) AS month, sum(f.net_revenue) AS revenue
  FROM fact f LEFT JOIN dim_geography g ON f.geo_key = g.geo_key WHERE f.order_date IS NOT NULL GROUP BY 1, 2
), spans AS (
  SELECT region, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM months GROUP BY region
), series AS (
  SELECT s.region, CAST(s.month AS DATE) AS month, CAST(coalesce(m.revenue, 0) AS DECIMAL(28,2)) AS y,
         row_number() OVER (PARTITION BY s.region ORDER BY s.month) AS t
  FROM spans s LEFT JOIN months m ON s.region = m.region AND CAST(s.month AS DATE) = m.month
), opening AS (
  SELECT region, CAST(sum(y) AS DOUBLE) / 12 AS level, list(CAST(y AS DOUBLE) ORDER BY t) AS ys FROM series WHERE t <= 12
  GROUP BY region HAVING count(*) = 12
), state AS (
  SELECT region, CAST(12 AS BIGINT) AS t, level, CAST(0 AS DOUBLE) AS trend, list_transform(ys, lambda v: v - level) AS season, CAST(NULL AS DOUBLE) AS forecast
  FROM opening
  UNION ALL
  SELECT region, t, level, 0.125::DOUBLE * (level - old) + (1.0::DOUBLE - 0.125::DOUBLE) * trend,
         list_concat(season[2:12], [0.5::DOUBLE * (y - level) + (1.0::DOUBLE - 0.5::DOUBLE) * season[1]]), old + trend + season[1]
  FROM (SELECT s.region, n.t, CAST(n.y AS DOUBLE) AS y, s.level AS old, s.trend, s.season,
               0.25::DOUBLE * (CAST(n.y AS DOUBLE) - s.season[1]) + (1.0::DOUBLE - 0.25::DOUBLE) * (s.level + s.trend) AS level
        FROM state s JOIN series n ON s.region = n.region AND n.t = s.t + 1)
), smoothed AS (
  SELECT n.region, n.month, n.y AS revenue, s.forecast FROM series n LEFT JOIN state s ON n.region = s.region AND n.t = s.t
  UNION ALL
  SELECT s.region, CAST(n.month + to_months(CAST(k AS INTEGER)) AS DATE), NULL, s.level + k * s.trend + s.season[k]
  FROM state s JOIN series n ON n.region = s.region AND n.t = s.t, generate_series(1, 12) AS g(k)
  WHERE s.t = (SELECT max(t) FROM series x WHERE x.region = s.region)
)"""
oracle("region_seasonal_forecast", with_base("""
SELECT region, CAST(month AS TIMESTAMP) AS month, CAST(revenue AS DOUBLE) AS revenue, forecast FROM smoothed""", [SMOOTHED])
    .replace("WITH", "WITH RECURSIVE", 1))
oracle("region_vs_seasonal_forecast", with_base("""
SELECT region, year, months, CAST(revenue AS DOUBLE) AS revenue, CAST(forecast AS DOUBLE) AS forecast,
       CASE WHEN revenue < forecast THEN 'under' ELSE 'on_or_above' END AS status
FROM (SELECT region, year(month) AS year, count(*) AS months, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue,
             CAST(sum(CAST(round(forecast * 100) AS DECIMAL(28,0))) / 100.0 AS DECIMAL(28,2)) AS forecast
      FROM smoothed WHERE revenue IS NOT NULL AND forecast IS NOT NULL GROUP BY 1, 2)""", [SMOOTHED])
    .replace("WITH", "WITH RECURSIVE", 1))
oracle("new_vs_returning", with_base("""
SELECT is_first_order, count(*) AS order_lines, count(DISTINCT order_id) AS orders,
       CAST(CAST(sum(net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS revenue
FROM fact GROUP BY 1"""))
oracle("segment_revenue_at_order_time", with_base("""
SELECT d.customer_segment, count(*) AS order_lines,
       CAST(CAST(sum(f.net_revenue) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(f.discount_amount) AS DECIMAL(18,2)) AS DOUBLE) AS discount_amount,
       CAST(CAST(sum(f.tax_amount) AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,
       CAST(CAST(sum(f.gross_profit) AS DECIMAL(18,2)) AS DOUBLE) AS gross_profit
FROM fact f LEFT JOIN dim_customer d ON f.customer_key = d.customer_key GROUP BY 1"""))

# --- streaming: equal to the batch results -----------------------------------------------

oracle("stream_fact_upsert", ORACLE["fact_orders"])
oracle("stream_scd2_merge", with_base(R("ms", **MERGE_REPORT), [merged_cte("ms", 0, src="stg_customers")]))
oracle("stream_scd2_state", ORACLE["stream_scd2_merge"])

oracle("stg_events", """
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_date,
       CAST(user_id AS VARCHAR) AS user_id, lower(trim(event_type)) AS event_type,
       CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS event_value, nullif(trim(props), '') AS properties
FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, user_id DESC, event_type DESC, value DESC, props DESC) = 1""")

oracle("stg_orders_cleaned", """
WITH raw AS (
  SELECT o_orderkey, o_orderdate, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, o_orderdate - INTERVAL 1 DAY, o_custkey, '  ' || lower(o_orderstatus), o_totalprice, '  ' FROM orders WHERE o_orderkey % 97 = 0
  UNION ALL SELECT o_orderkey, o_orderdate, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 97 = 1
), tidy AS (
  SELECT o_orderkey, o_orderdate, o_custkey, nullif(upper(trim(o_orderstatus)), '') AS o_orderstatus, o_totalprice,
         nullif(upper(trim(o_orderpriority)), '') AS o_orderpriority FROM raw)
SELECT * FROM tidy QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST, o_custkey DESC NULLS LAST,
  o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderpriority DESC NULLS LAST) = 1""")
CLEANED_CUSTOMERS = """
raw AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal FROM customer
  UNION ALL SELECT c_custkey, ' ' || c_name || '  ', lower(c_mktsegment), c_nationkey, c_acctbal FROM customer WHERE c_custkey % 13 = 0
), cleaned AS (
  SELECT c_custkey, nullif(trim(c_name), '') AS c_name, nullif(upper(trim(c_mktsegment)), '') AS c_mktsegment, c_nationkey, c_acctbal FROM raw
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY trim(c_name) DESC NULLS LAST, upper(trim(c_mktsegment)) DESC NULLS LAST,
    c_nationkey DESC NULLS LAST, c_acctbal DESC NULLS LAST) = 1)"""
oracle("stg_customers_cleaned", f"WITH {CLEANED_CUSTOMERS} SELECT * FROM cleaned")
oracle("dq_customers_without_order", f"""WITH {CLEANED_CUSTOMERS}
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name FROM cleaned
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 13 <> 0)""")

JOB_LOG = """
job_log AS (
  SELECT 'job_' || CAST(event_id AS VARCHAR) AS job_id, upper(event_type) AS statement_type,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'QUERY'
              WHEN event_type = 'signup' THEN 'LOAD' ELSE 'EXTRACT' END AS job_type,
         CAST(round(value * 1e7) AS BIGINT) AS total_bytes_processed,
         CAST(round(value * 1000) AS BIGINT) AS total_slot_ms,
         ts AS start_time, ts + to_seconds(user_id % 60) AS end_time, ts AS creation_time, props AS query
  FROM events)"""
oracle("job_log_report", f"""WITH {JOB_LOG}
SELECT job_id, statement_type, total_bytes_processed / POW(10, 9) AS gb_processed,
       total_slot_ms / 1000 AS slot_seconds,
       CAST(floor(epoch(end_time)) - floor(epoch(start_time)) AS BIGINT) AS wall_seconds,
       query, creation_time
FROM job_log
WHERE creation_time >= (SELECT max(creation_time) FROM job_log) - INTERVAL 1 DAY AND job_type = 'QUERY'
ORDER BY creation_time DESC, job_id
LIMIT 50""")
