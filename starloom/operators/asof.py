"""As-of join by carrying: work is lines + versions, not lines x versions.

Lines and versions of a key are put in one order (by key and time, versions
first at equal times) and cut into range slices, so that a hot key spans many
tasks. Inside a slice the last version is carried down to the lines after it;
into a slice comes the last version of the key in the slices before, from a
summary with at most one row per slice for any key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.scd2 import CONTIGUOUS, pit_upper


def asof_join(lines: DataFrame, versions: DataFrame, key: str = "customer_id", at: str = "order_date",
              take=("customer_key",), convention: str = CONTIGUOUS, slices: int | None = None) -> DataFrame:
    """Attach to every line the version of its key that is in force at ``at``:
    the last one that starts at or before it, if it has not ended by then.

    The same rows as ``pit.pit_join`` where versions do not overlap; where they
    do, the latest start counts. Lines without a key, time or version get NULLs.
    """
    taken = F.struct(pit_upper(F.col("valid_to"), convention).alias("_to"), *[F.col(c) for c in take])
    v = versions.select(F.col(key).alias("_k"), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"), taken.alias("_v"))
    rows = lines.select(F.col(key).alias("_k"), F.col(at).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"),
                        F.struct(*[F.col(c) for c in lines.columns]).alias("_line"))
    both = v.unionByName(rows, allowMissingColumns=True)
    order = ["_k", "_t", "_kind"]
    cut = both.repartitionByRange(slices, *order) if slices else both.repartitionByRange(*order)
    cut = cut.withColumn("_slice", F.spark_partition_id()).checkpoint()  # every use sees the same slices
    inside = W.partitionBy("_slice", "_k").orderBy("_t", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = cut.withColumn("_own", F.last("_v", ignorenulls=True).over(inside)).filter(F.col("_kind") == 1)
    ends = cut.filter(F.col("_kind") == 0).groupBy("_slice", "_k").agg(F.max_by("_v", "_t").alias("_end"))
    # a row for every slice that has lines or versions of the key, with the last version before it
    here = cut.select("_slice", "_k").distinct().join(ends, ["_slice", "_k"], "left")
    before = W.partitionBy("_k").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    into = here.select("_slice", "_k", F.last("_end", ignorenulls=True).over(before).alias("_into")).filter(F.col("_into").isNotNull())
    out = carried.join(into, ["_slice", "_k"], "left").withColumn("_v", F.coalesce("_own", "_into"))
    live = F.col("_k").isNotNull() & (F.col("_t") < F.col("_v._to"))
    return out.select("_line.*", *[F.when(live, F.col(f"_v.{c}")).alias(c) for c in take])
