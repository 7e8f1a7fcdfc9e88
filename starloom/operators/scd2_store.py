"""A stored type-2 dimension of which a merge writes only what it changes.

``current`` holds the current versions in hash buckets of the key, a partition
each; ``closed`` the versions that have ended, in the same buckets, in a folder
per merge. A merge reads the buckets of its keys, writes again those in which a
version opens and adds the versions that end; nothing else is touched.

The new rows are written beside the table (``_redo``), then a plan: a merge
broken off before the plan has not happened, one after it is carried out again by
the next writer. Readers in between may see it half done.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import layout, scd2

BUCKETS = 64
BUCKET, PART = "_bucket", "_part"


class Scd2Store:
    """The dimension under ``base``; ``merge_kw`` as of ``scd2.scd2_changes``.

    ``buckets`` belongs to the table: it is kept with it and the kept number counts.
    """

    def __init__(self, spark: SparkSession, base: str, natural_key="customer_id", buckets: int = BUCKETS, **merge_kw):
        self.spark, self.base = spark, base.rstrip("/")
        self.keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
        self.merge_kw = merge_kw
        kept = f"{self.base}/buckets"
        if not layout.path_exists(spark, kept):
            layout.publish(spark, kept, str(buckets))
        self.buckets = int(spark.read.text(kept).first()[0])

    def _stored(self, part: str, buckets: list | None = None) -> DataFrame | None:
        path = f"{self.base}/{part}"
        if not layout.path_exists(self.spark, path):
            return None
        rows = self.spark.read.parquet(path)
        return rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))

    def _rows(self, buckets: list | None = None) -> DataFrame | None:
        parts = [p.drop("merge", BUCKET) for p in (self._stored("current", buckets), self._stored("closed", buckets)) if p is not None]
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else None

    def read(self) -> DataFrame:
        """The whole dimension, as ``scd2.scd2_merge`` would have it."""
        self.recover()
        rows = self._rows()
        if rows is None:
            raise FileNotFoundError(f"no dimension under {self.base}")
        return rows

    def merge(self, incoming: DataFrame) -> DataFrame:
        """Apply a batch of changes; returns the rejected rows."""
        self.recover()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        batch = incoming.checkpoint(eager=True)
        asked = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most the number of buckets
        dim = self._rows(asked) if asked else None
        if dim is None:
            dim = scd2.empty_like_dim(batch, self.keys, self.merge_kw.get("attributes"), self.merge_kw.get("surrogate", "customer_key"))
        ch = scd2.scd2_changes(dim, batch, natural_key=self.keys, **self.merge_kw)
        rejected = ch.rejected.checkpoint(eager=True)  # the files it is read from are about to go
        opened = ch.opened.withColumn(BUCKET, bucket).checkpoint(eager=True)
        changed = [r[0] for r in opened.select(BUCKET).distinct().collect()]
        if not changed:
            return rejected
        new = opened
        current = self._stored("current", changed)
        if current is not None:
            firsts = opened.groupBy(*self.keys).agg(F.min("valid_from").alias(scd2.FIRST))
            current = current.select(*opened.columns)
            new = new.unionByName(current.join(firsts, self.keys, "left_anti")) \
                .unionByName(ch.close(current, firsts).withColumn(BUCKET, bucket))
        staged = new.withColumn(PART, F.when(F.col("is_current"), "current").otherwise("closed"))
        staged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(PART, BUCKET).parquet(f"{self.base}/{layout.REDO}/rows")
        layout.publish(self.spark, f"{self.base}/{layout.REDO}/plan", json.dumps({"merge": f"m{uuid.uuid4().hex}"}))
        self.recover()
        return rejected

    def recover(self) -> bool:
        """Carry out a merge that was decided, drop one that was not; whether there was one to carry out."""
        fs, redo, _ = layout._fs(self.spark, f"{self.base}/{layout.REDO}")
        if not fs.exists(redo):
            return False
        plan = f"{self.base}/{layout.REDO}/plan"
        decided = layout.path_exists(self.spark, plan)
        if decided:
            merge = json.loads(self.spark.read.text(plan, wholetext=True).first()[0])["merge"]
            staged = self.spark.read.parquet(f"{self.base}/{layout.REDO}/rows")
            for part, path in (("closed", f"{self.base}/closed/merge={merge}"), ("current", f"{self.base}/current")):
                _write(staged.filter(F.col(PART) == part).drop(PART), path)
        fs.delete(redo, True)
        return decided


def _write(rows: DataFrame, path: str) -> None:
    """Put the rows' buckets in place of those there."""
    if not rows.isEmpty():
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
