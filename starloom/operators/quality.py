"""Data-quality checks run after each load.

Each check returns a DataFrame of failing rows (or counts); a check passes
when its failing set is empty / its count is 0. Literal forms mirror the
modelled tests; strict forms close their blind spots (keys with no current
row, gaps before the current row, overlapping versions).

All checks are single-pass aggregates or neighbour lookups per key
(``sequence.with_neighbours``, which spreads a key over several tasks);
none collects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from starloom.functions.dates import whole_seconds
from starloom.operators.joins import BROADCAST_MAX_BYTES, measured_bytes, packed
from starloom.operators.sequence import with_neighbours


def _count(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def orphaned_orders(fact: DataFrame) -> DataFrame:
    """Fact rows without a customer version (expected 0)."""
    return _count(fact.filter(F.col("customer_key").isNull()), "orphaned_orders")


def revenue_errors(fact: DataFrame) -> DataFrame:
    """Rows with net revenue above gross (expected 0)."""
    return _count(fact.filter(F.col("net_revenue") > F.col("gross_revenue")), "revenue_errors")


def duplicate_keys(fact: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys that occur more than once (expected empty for a primary key)."""
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def completeness_recent(fact: DataFrame, as_of, days: int = 3) -> DataFrame:
    """Lines per day over the last ``days`` days before ``as_of``, newest first."""
    start = F.date_sub(F.lit(as_of).cast("timestamp_ntz").cast("date"), days)
    return (
        fact.filter(F.col("order_date") >= start)
        .groupBy("order_date").agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy(F.desc("order_date"))
    )


# --- SCD2 integrity ---------------------------------------------------------

def scd2_current_count(dim: DataFrame, key: str = "customer_id", strict: bool = False) -> DataFrame:
    """Keys whose number of current rows is not exactly one.

    Literal: counts among current rows only, so keys with zero current rows
    pass. Strict: counts over every key.
    """
    if not strict:
        return (dim.filter(F.col("is_current")).groupBy(key)
                .agg(F.count(F.lit(1)).alias("current_row_count"))
                .filter(F.col("current_row_count") != 1))
    return (dim.groupBy(key)
            .agg(F.sum(F.col("is_current").cast("int")).cast("long").alias("current_row_count"))
            .filter(F.col("current_row_count") != 1))


def _with_next(dim: DataFrame, key: str) -> DataFrame:
    d = with_neighbours(dim.select(key, "valid_from", "valid_to", "is_current"), key, "valid_from",
                        next_cols=["valid_from"])
    nxt = F.col("_next_valid_from")
    return d.select(key, "valid_from", "valid_to", "is_current",
                    nxt.alias("next_valid_from"),
                    whole_seconds(F.col("valid_to"), nxt).alias("gap_seconds"))


def scd2_gaps(dim: DataFrame, key: str = "customer_id", strict: bool = False,
              tolerance_s: int = 1) -> DataFrame:
    """Versions followed by a gap of more than ``tolerance_s`` seconds.

    Literal: only closed rows are ordered, so the gap before the current row
    is not seen. Strict: all rows.
    """
    src = dim if strict else dim.filter(~F.col("is_current"))
    return _with_next(src, key).filter(F.col("gap_seconds") > tolerance_s)


def scd2_overlaps(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Versions whose successor starts before they end (strict only)."""
    return _with_next(dim, key).filter(F.col("gap_seconds") < 0)


def scd2_bad_ranges(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_from") >= F.col("valid_to"))


def assert_scd2(dim: DataFrame, key: str = "customer_id", strict: bool = False) -> DataFrame:
    """All failures as (key, issue); the test passes on zero rows."""
    parts = [
        scd2_current_count(dim, key, strict).select(key, F.lit("multiple_current_records").alias("issue")),
        scd2_gaps(dim, key, strict).select(key, F.lit("date_gap_found").alias("issue")),
        scd2_bad_ranges(dim).select(key, F.lit("invalid_date_range").alias("issue")),
    ]
    if strict:
        parts.append(scd2_overlaps(dim, key).select(key, F.lit("overlapping_versions").alias("issue")))
    return reduce(DataFrame.unionByName, parts)


# --- referential integrity and declared constraints -------------------------

def orphans_all_fks(fact: DataFrame, dims: dict) -> DataFrame:
    """Per foreign key, fact rows whose key is NULL or absent from its dimension.

    ``dims`` maps fk column -> (dimension DataFrame, its key column). A dimension whose
    keys are small enough is broadcast and no line is shuffled for it; for a larger one the
    lines are counted by key, map-side first, and the counts meet the dimension.
    """
    def key(c):
        return packed(F.col(c).cast("string")).alias("value")

    def orphans(fk, dim, pk):
        values, known = fact.select(key(fk)), dim.select(key(pk))
        if measured_bytes(known) <= BROADCAST_MAX_BYTES:
            n = F.count(F.lit(1))
            missing = values.join(F.broadcast(known), "value", "left_anti")
        else:
            n = F.coalesce(F.sum("_n"), F.lit(0))
            missing = values.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).join(known, "value", "left_anti")
        return missing.agg(n.alias("orphans")).select(F.lit(fk).alias("foreign_key"), "orphans")

    return reduce(DataFrame.unionByName, [orphans(fk, dim, pk) for fk, (dim, pk) in dims.items()])


def constraint_violations(df: DataFrame, table: str, not_null, primary_key=None) -> DataFrame:
    """NOT NULL counts in one aggregate pass, plus primary-key duplicates."""
    aggs = [F.sum(F.col(c).isNull().cast("int")).cast("long").alias(c) for c in not_null]
    nn = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    out = nn.select(F.expr(f"stack({len(not_null)}, {stack}) AS (column_name, violations)"))
    out = out.select(F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"),
                     "column_name", F.col("violations").cast("long").alias("violations"))
    if primary_key:
        key = packed(primary_key) if isinstance(df.schema[primary_key].dataType, StringType) else F.col(primary_key)
        dup = (df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
               .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations")))
        out = out.unionByName(dup.select(F.lit(table).alias("table_name"), F.lit("primary_key").alias("check_name"),
                                         F.lit(primary_key).alias("column_name"), "violations"))
    return out


def rows_lost(before: DataFrame, now: DataFrame) -> DataFrame:
    """How many rows of ``before`` are not in ``now`` (a row that is there n times counts n times):
    the count of ``exceptAll``, with rows compared by a digest of their values, so that 16 bytes of each are shuffled."""
    # a value is its length and its text, so that no two rows read the same
    values = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
              for t in (F.col(f"`{c}`").cast("string") for c in before.columns)]

    def counted(df: DataFrame, n: int) -> DataFrame:
        return df.select(F.unhex(F.md5(F.concat(*values))).alias("_row"), F.lit(n).cast("long").alias("_n"))
    rows = counted(before, 1).unionByName(counted(now.select(*before.columns), -1)).groupBy("_row").agg(F.sum("_n").alias("_n"))
    return rows.agg(F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0)).cast("long").alias("rows_lost"))
