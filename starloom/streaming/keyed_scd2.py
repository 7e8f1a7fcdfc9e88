"""A type-2 dimension as the log of a stateful stream.

``stream.stream_scd2`` writes the whole dimension once per micro-batch. Here the
stream's state holds the start and hash of each key's current version, in hash buckets
of keys (a call of Python per bucket and micro-batch, not per key), and the
output is an append-only log of one row per version that opens, so the bytes of
a micro-batch follow its changes. A row names the start of the version that it
ends (``prev_from``), which is all that ``dimension`` needs to close versions: a
join on key and start, in which a key with many versions spreads over all tasks.

The log is written by Spark's file sink, which counts a micro-batch once however
often it is tried. A row that cannot open a version (dated at or before the
current one, or without a key or time) goes to the log as ``refused``; the state
has no older versions to compare it with, so ``refused_rows`` does that from the
log, and leaves out rows that agree with the version in force at their time.

The rows of a bucket in one micro-batch are sorted in one task; ``max_files`` bounds
the micro-batch. The number of buckets belongs to the stream's checkpoint, as does its
state: a changed one needs a new checkpoint.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from starloom.functions.keys import change_hash, surrogate_key
from starloom.operators.asof import asof_join
from starloom.operators.scd2 import MINUS_1S
from starloom.params import CUSTOMER_ATTRIBUTES, CUSTOMER_TRACKED, SCD2_MAX_TS

OPEN, REFUSED = "open", "refused"
BUCKETS, BUCKET = 1 << 14, "_bucket"


def _keys(natural_key) -> list[str]:
    return [natural_key] if isinstance(natural_key, str) else list(natural_key)


def version_log(changes: DataFrame, natural_key="customer_id", tracked=None, attributes=None,
                valid_from_col: str = "updated_at", as_of=None, buckets: int = BUCKETS) -> DataFrame:
    """The log of a stream of changes: event, keys, attributes, valid_from,
    prev_from, dw_created_at.

    Columns pass through the state operator as text and are cast back (atomic
    types; no binary). Of several rows of a key and time the one with the
    smallest hash counts and those that differ from it are refused; a row equal
    to the version before it opens nothing, and neither does a repeated one.
    """
    keys = _keys(natural_key)
    tracked = list(tracked or CUSTOMER_TRACKED)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    carried = [*keys, *attributes]
    types = {c: changes.schema[c].dataType for c in carried}
    texts = changes.select(
        *[F.col(c).cast("string").alias(c) for c in carried],
        F.col(valid_from_col).cast("timestamp_ntz").cast("string").alias("valid_from"),
        change_hash(tracked).alias("_h"), F.xxhash64(*carried).alias("_tie"),
        F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).alias(BUCKET))
    out = ["event", *carried, "valid_from", "prev_from"]
    log = texts.groupBy(BUCKET).applyInPandasWithState(
        _step(len(keys), texts.columns, out), ", ".join(f"`{c}` string" for c in out),
        "versions string", "append", GroupStateTimeout.NoTimeout)
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    return log.select("event", *[F.col(c).cast(types[c]).alias(c) for c in carried],
                      F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
                      F.col("prev_from").cast("timestamp_ntz").alias("prev_from"), now.alias("dw_created_at"))


def _step(n_keys: int, names: list[str], out: list[str]):
    """The state function; nested, so that it travels by value."""
    at, own, tie = (names.index(c) for c in ("valid_from", "_h", "_tie"))
    opens, refuses = OPEN, REFUSED

    def step(key, batches, state):
        rows = [r for part in batches for r in zip(*(part[c].tolist() for c in names))]
        rows.sort(key=lambda r: (r[at] or "", r[own], r[tie]))
        held = {tuple(k): (start, value) for k, start, value in json.loads(state.get[0])} if state.exists else {}
        log, opened = [], False
        for r in rows:
            k, t, h, carried = r[:n_keys], r[at], r[own], r[:at]
            start, value = held.get(k, (None, None))
            if t is None or any(part is None for part in k):
                log.append((refuses, *carried, t, None))
            elif start is not None and t <= start:
                if (t, h) != (start, value):
                    log.append((refuses, *carried, t, None))
            elif h != value:
                log.append((opens, *carried, t, start))
                held[k], opened = (t, h), True
        if opened:
            state.update((json.dumps([(k, *v) for k, v in held.items()]),))
        if log:
            yield pd.DataFrame(log, columns=out, dtype=object)

    return step


def stream_scd2_state(spark: SparkSession, landing: str, schema, log_path: str, checkpoint: str,
                      max_files: int | None = None, available_now: bool = True, **log_kw):
    """Append the version log of the changes that arrive in ``landing`` to ``log_path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    w = version_log(reader.parquet(landing), **log_kw).writeStream.format("parquet").outputMode("append") \
        .partitionBy("event").option("path", log_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def dimension(log: DataFrame, natural_key="customer_id", attributes=None, surrogate: str = "customer_key",
              max_ts: str = SCD2_MAX_TS) -> DataFrame:
    """The dimension that a log tells of, in the columns of ``scd2.scd2_merge``."""
    keys = _keys(natural_key)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    opened = log.filter(F.col("event") == OPEN)
    ends = opened.filter(F.col("prev_from").isNotNull()).select(
        *keys, F.col("prev_from").alias("valid_from"), F.col("valid_from").alias("_next"), F.col("dw_created_at").alias("_ended"))
    nxt = F.col("_next")
    return opened.drop("prev_from").join(ends, [*keys, "valid_from"], "left").select(
        surrogate_key(*keys, "valid_from").alias(surrogate), *keys, *attributes, "valid_from",
        F.coalesce(nxt - F.expr("INTERVAL 1 SECOND"), F.lit(max_ts).cast("timestamp_ntz")).alias("valid_to"),
        nxt.isNull().alias("is_current"), "dw_created_at", F.coalesce("_ended", "dw_created_at").alias("dw_updated_at"))


def refused_rows(log: DataFrame, natural_key="customer_id", tracked=None, attributes=None) -> DataFrame:
    """Changes that could not be applied and contradict the version in force at
    their time, or precede the key's first one, as often as they arrived."""
    keys = _keys(natural_key)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    h = change_hash(list(tracked or CUSTOMER_TRACKED))
    late = log.filter(F.col("event") == REFUSED).select(
        *keys, *attributes, "valid_from", surrogate_key(*keys).alias("_key"), h.alias("_own"))
    versions = dimension(log, keys, attributes).select(
        "valid_from", "valid_to", surrogate_key(*keys).alias("_key"), h.alias("_h"))
    told = asof_join(late, versions, key="_key", at="valid_from", take=["_h"], convention=MINUS_1S)
    return told.filter(F.col("_h").isNull() | (F.col("_h") != F.col("_own"))).select(*keys, *attributes, "valid_from")
