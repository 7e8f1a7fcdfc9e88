"""Previous / next row of the same key, without one task per key.

``F.lag``/``F.lead`` over ``Window.partitionBy(key)`` put every row of a key
in one task; a key holding a large share of the rows then runs alone. Here
the rows are range-partitioned by (key, order) into slices (``buckets``, or
the session's shuffle partitions), so a hot key spans several slices. Inside a slice the neighbour is a plain
lag/lead; across slices it is carried from a per-(slice, key) summary (the
last / first row of the key in the neighbouring slice), and that summary
has at most one row per slice for any one key. The sliced rows are
checkpointed so every use sees the same slice of each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_neighbours(df: DataFrame, keys, order_col: str, prev_cols=(), next_cols=(),
                    position: str | None = None, buckets: int | None = None,
                    checkpoint: bool = True) -> DataFrame:
    """Add ``_prev_<c>`` for ``prev_cols`` (value on the previous row of the
    same key by ``order_col``) and ``_next_<c>`` for ``next_cols`` (value on
    the next row), NULL at the key's first / last row; with ``position``, a
    column of that name with the row's 1-based position within its key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    # without an explicit count the session's shuffle partitions apply and
    # AQE may merge neighbouring ranges of small data; merged slices stay
    # contiguous and in order, which is all the carry step needs
    rng = df.repartitionByRange(buckets, *keys, order_col) if buckets else df.repartitionByRange(*keys, order_col)
    part = rng.withColumn("_pid", F.spark_partition_id())
    if checkpoint:
        part = part.checkpoint(eager=True)
    w = W.partitionBy("_pid", *keys).orderBy(order_col)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = part.withColumn("_rn", F.row_number().over(w)).withColumn("_cnt", F.count(F.lit(1)).over(whole))
    for c in prev_cols:
        out = out.withColumn(f"_in_prev_{c}", F.lag(c).over(w))
    for c in next_cols:
        out = out.withColumn(f"_in_next_{c}", F.lead(c).over(w))

    summ = part.groupBy("_pid", *keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(c, order_col).alias(f"_last_{c}") for c in prev_cols],
        *[F.min_by(c, order_col).alias(f"_first_{c}") for c in next_cols],
    )
    ws = W.partitionBy(*keys).orderBy("_pid")
    carry = summ.select(
        "_pid", *keys,
        F.coalesce(F.sum("_n").over(ws.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        *[F.lag(f"_last_{c}").over(ws).alias(f"_carry_prev_{c}") for c in prev_cols],
        *[F.lead(f"_first_{c}").over(ws).alias(f"_carry_next_{c}") for c in next_cols],
    )
    out = out.join(carry, ["_pid", *keys], "left")
    for c in prev_cols:
        out = out.withColumn(f"_prev_{c}", F.when(F.col("_rn") == 1, F.col(f"_carry_prev_{c}"))
                             .otherwise(F.col(f"_in_prev_{c}")))
    for c in next_cols:
        out = out.withColumn(f"_next_{c}", F.when(F.col("_rn") == F.col("_cnt"), F.col(f"_carry_next_{c}"))
                             .otherwise(F.col(f"_in_next_{c}")))
    if position:
        out = out.withColumn(position, (F.col("_rn") + F.col("_before")).cast("int"))
    drop = ["_pid", "_rn", "_cnt", "_before"] + [f"_in_prev_{c}" for c in prev_cols] + [f"_carry_prev_{c}" for c in prev_cols] \
        + [f"_in_next_{c}" for c in next_cols] + [f"_carry_next_{c}" for c in next_cols]
    return out.drop(*drop)
