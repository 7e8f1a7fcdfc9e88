"""Declared table schemas and ``conform`` (typed table creation).

Parquet does not enforce NOT NULL or defaults, so a table's declared shape
is applied as a cast-select: every declared column in order, cast to its
type, defaults filled with ``coalesce``. Keys and NOT NULL become
data-quality checks (``quality.constraint_violations``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, TS, B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()


def _dec(p, s):
    return T.DecimalType(p, s)


FACT_SCHEMA = T.StructType([
    T.StructField("order_key", S, False),
    T.StructField("order_line_id", S, False),
    T.StructField("customer_key", S, False),
    T.StructField("customer_id", S, False),
    T.StructField("product_key", S, False),
    T.StructField("date_key", I, False),
    T.StructField("geo_key", S, True),
    T.StructField("order_id", S, False),
    T.StructField("order_timestamp", TS, False),
    T.StructField("order_date", D, False),
    T.StructField("channel", S, True),
    T.StructField("quantity", I, True),
    T.StructField("unit_price", _dec(12, 2), True),
    T.StructField("discount_pct", _dec(5, 2), True),
    T.StructField("discount_amount", _dec(12, 2), True),
    T.StructField("gross_revenue", _dec(12, 2), True),
    T.StructField("net_revenue", _dec(12, 2), True),
    T.StructField("cost_of_goods", _dec(12, 2), True),
    T.StructField("gross_profit", _dec(12, 2), True),
    T.StructField("shipping_cost", _dec(8, 2), True),
    T.StructField("tax_amount", _dec(8, 2), True),
    T.StructField("return_flag", B, True),
    T.StructField("is_first_order", B, True),
    T.StructField("fulfillment_days", I, True),
    T.StructField("dw_loaded_at", TS, True),
])

# Column defaults at insert: value, or "now" for the load timestamp.
FACT_DEFAULTS = {"return_flag": False, "dw_loaded_at": "now"}
DIM_CUSTOMER_DEFAULTS = {"valid_to": "9999-12-31 23:59:59", "is_current": True,
                         "dw_created_at": "now", "dw_updated_at": "now"}


DIM_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_key", S, False),
    T.StructField("customer_id", S, False),
    T.StructField("email", S, True),
    T.StructField("full_name", S, True),
    T.StructField("first_name", S, True),
    T.StructField("last_name", S, True),
    T.StructField("acquisition_channel", S, True),
    T.StructField("acquisition_date", D, True),
    T.StructField("customer_segment", S, True),
    T.StructField("lifetime_value", _dec(12, 2), True),
    T.StructField("city", S, True),
    T.StructField("state", S, True),
    T.StructField("country", S, True),
    T.StructField("is_active", B, True),
    T.StructField("valid_from", TS, False),
    T.StructField("valid_to", TS, False),
    T.StructField("is_current", B, False),
    T.StructField("dw_created_at", TS, True),
    T.StructField("dw_updated_at", TS, True),
])


def create_if_absent(spark, path: str, schema: T.StructType) -> bool:
    """Write an empty typed table unless one is there; whether it was written."""
    from starloom.operators.layout import path_exists

    if path_exists(spark, f"{path}/_SUCCESS"):
        return False
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return True


def append_conformed(df: DataFrame, path: str, schema: T.StructType, defaults: dict | None = None, as_of=None) -> None:
    """Insert rows into a typed table: its columns and types, its defaults."""
    conform(df, schema, defaults, as_of).write.mode("append").parquet(path)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None, as_of=None) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order and types; missing
    columns become typed NULLs; ``defaults`` fill NULLs."""
    defaults = defaults or {}
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            v = defaults[f.name]
            dv = now if v == "now" else F.lit(v).cast(f.dataType)
            c = F.coalesce(c, dv)
        cols.append(c.alias(f.name))
    return df.select(*cols)
