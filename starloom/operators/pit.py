"""Point-in-time (interval) join of facts to a type-2 dimension.

Spark has no interval join, but this one is an equi-join on the natural key
with a residual range predicate, so it plans as a sort-merge (or broadcast
hash) join with a condition: the key decides the partition, the range only
filters matching pairs. A key has one version per change, so the build side
per key is small; a hot key on the fact side is split by AQE's skew-join
handling (the fact is the preserved side of a left join, which AQE can
split). At most one version matches when the intervals do not overlap (the
strict SCD2 checks verify this).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.scd2 import CONTIGUOUS, pit_upper


def pit_join(facts: DataFrame, dim: DataFrame, natural_key: str = "customer_id",
             at: str = "order_date", take=("customer_key",), convention: str = CONTIGUOUS,
             how: str = "left") -> DataFrame:
    """Attach the dimension version valid at ``facts[at]``.

    ``at`` may be a DATE (compared as midnight) or a timestamp column.
    ``convention`` is ``contiguous`` (valid_to = next start) or ``minus_1s``
    (valid_to = next start - 1 s, as the merge writes it).
    """
    d = dim.select(
        F.col(natural_key).alias("_pit_key"),
        F.col("valid_from").alias("_pit_from"),
        pit_upper(F.col("valid_to"), convention).alias("_pit_to"),
        *[F.col(c) for c in take],
    )
    t = F.col(at).cast("timestamp_ntz")
    cond = (
        (facts[natural_key] == d["_pit_key"])
        & (t >= d["_pit_from"])
        & (t < d["_pit_to"])
    )
    return facts.join(d, cond, how).drop("_pit_key", "_pit_from", "_pit_to")


MIN_TS = "0001-01-01 00:00:00"
END_TS = "9999-12-31 23:59:59"


def customer_timeline(dim: DataFrame, first_order_dates: DataFrame | None = None,
                      natural_key: str = "customer_id", convention: str = CONTIGUOUS,
                      take=("customer_key",)) -> DataFrame:
    """Cover each key's whole time line with half-open ``[valid_from, valid_to)``
    pieces: its versions, plus key-less pieces before the first version, in
    any gap between versions, and one open piece for keys with no version.
    First-order dates (if given) ride along on every piece.

    With the cover, one point-in-time join returns the version and the
    first-order date together, so the fact meets exactly one join on the
    customer key: a single sort-merge join that AQE's skew handling can split
    for a hot customer (two adjacent joins would stop AQE from splitting the
    first without re-shuffling for the second).
    """
    from starloom.operators.sequence import with_neighbours

    lo = F.lit(MIN_TS).cast("timestamp_ntz")
    hi = F.lit(END_TS).cast("timestamp_ntz")
    none = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in take]
    v = dim.select(F.col(natural_key), F.col("valid_from"),
                   pit_upper(F.col("valid_to"), convention).alias("valid_to"), *take)
    nb = with_neighbours(v.select(natural_key, "valid_from", "valid_to"), natural_key, "valid_from",
                         next_cols=["valid_from"], position="n")
    nxt = nb.select(natural_key, F.col("valid_to").alias("gap_from"),
                    F.col("_next_valid_from").alias("gap_to"),
                    "n", F.col("valid_from").alias("first_from"))
    gaps = nxt.filter(F.col("gap_to") > F.col("gap_from")).select(
        natural_key, F.col("gap_from").alias("valid_from"), F.col("gap_to").alias("valid_to"), *none)
    before = nxt.filter(F.col("n") == 1).select(
        natural_key, lo.alias("valid_from"), F.col("first_from").alias("valid_to"), *none)
    cover = v.unionByName(gaps).unionByName(before)
    if first_order_dates is None:
        return cover
    keys = v.select(natural_key).distinct()
    unknown = first_order_dates.select(natural_key).join(keys, natural_key, "left_anti").select(
        natural_key, lo.alias("valid_from"), hi.alias("valid_to"), *none)
    return cover.unionByName(unknown).join(first_order_dates, natural_key, "left")
