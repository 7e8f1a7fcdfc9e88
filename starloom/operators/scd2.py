"""Slowly changing dimension, type 2.

Three entry points share one interval model:

- ``scd2_history``  change feed -> snapshot rows (valid_from, NULL-ended
  valid_to); consecutive rows with equal tracked attributes collapse.
- ``dim_from_snapshot``  snapshot -> dimension with surrogate key per
  version, open end = max timestamp, current flag, days active, version no.
  Intervals are contiguous: a version ends where the next begins.
- ``scd2_merge``  apply an incoming batch to an existing dimension without
  MERGE: untouched rows + closed rows + opened rows, built from one change
  set, so the step is atomic and a rerun with the same input is a no-op.
  Closed versions end one second before the next starts ("minus_1s").

The history builder and the version numbering take neighbours through
``sequence.with_neighbours`` (range slices of (key, time)), so a key with a
huge change feed is spread over many tasks. So do the merge's
per-key steps over a batch's candidate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_days
from starloom.functions.keys import change_hash, concat_hash, surrogate_key
from starloom.operators.sequence import with_neighbours
from starloom.params import CUSTOMER_ATTRIBUTES, CUSTOMER_TRACKED, SCD2_MAX_TS

CONTIGUOUS = "contiguous"
MINUS_1S = "minus_1s"


def _ts(value) -> "F.Column":
    return F.lit(value).cast("timestamp_ntz")


def _keys(natural_key) -> list[str]:
    return [natural_key] if isinstance(natural_key, str) else list(natural_key)


def scd2_history(feed: DataFrame, natural_key="customer_id", tracked=None,
                 ts_col: str = "updated_at", attributes=None) -> DataFrame:
    """Snapshot table from a change feed (or from stacked snapshots).

    Output: key, attributes, dbt_scd_id, dbt_valid_from, dbt_valid_to (NULL
    for the current version), dbt_updated_at. The feed must have one row per
    key and timestamp.
    """
    keys = _keys(natural_key)
    tracked = list(tracked or CUSTOMER_TRACKED)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    f = feed.select(*keys, *attributes, ts_col).withColumn("_h", change_hash(tracked))
    # previous / next row per key without putting a whole key in one task
    f = with_neighbours(f, keys, ts_col, prev_cols=["_h"])
    changes = f.filter(F.col("_prev__h").isNull() | (F.col("_prev__h") != F.col("_h")))
    changes = with_neighbours(changes.drop("_prev__h"), keys, ts_col, next_cols=[ts_col])
    return changes.select(
        *keys, *attributes,
        surrogate_key(*keys, ts_col).alias("dbt_scd_id"),
        F.col(ts_col).alias("dbt_valid_from"),
        F.col(f"_next_{ts_col}").alias("dbt_valid_to"),
        F.col(ts_col).alias("dbt_updated_at"),
    )


def dim_from_snapshot(snapshot: DataFrame, natural_key="customer_id", attributes=None,
                      surrogate: str = "customer_key", as_of=None,
                      max_ts: str = SCD2_MAX_TS) -> DataFrame:
    """Business-facing dimension over a snapshot table (contiguous intervals)."""
    keys = _keys(natural_key)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    now = _ts(as_of) if as_of is not None else F.localtimestamp()
    snapshot = with_neighbours(snapshot, keys, "dbt_valid_from", position="_version")
    return snapshot.select(
        surrogate_key(*keys, "dbt_valid_from").alias(surrogate),
        *keys, *attributes,
        F.col("dbt_valid_from").alias("valid_from"),
        F.coalesce(F.col("dbt_valid_to"), _ts(max_ts)).alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
        calendar_days("dbt_valid_from", F.coalesce(F.col("dbt_valid_to"), now)).alias("days_active"),
        F.col("_version").alias("version_number"),
        F.col("dbt_updated_at").alias("dw_updated_at"),
    )


def build_dim_customer(feed: DataFrame, as_of=None) -> DataFrame:
    """Customer change feed -> snapshot -> dimension."""
    return dim_from_snapshot(scd2_history(feed), as_of=as_of)


def empty_like_dim(incoming: DataFrame, natural_key="customer_id", attributes=None,
                   surrogate: str = "customer_key") -> DataFrame:
    """An empty merge target with the columns ``scd2_merge`` produces."""
    from pyspark.sql import types as T

    keys = _keys(natural_key)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    ts = T.TimestampNTZType()
    fields = ([T.StructField(surrogate, T.StringType())]
              + [incoming.schema[c] for c in keys + attributes]
              + [T.StructField("valid_from", ts), T.StructField("valid_to", ts),
                 T.StructField("is_current", T.BooleanType()),
                 T.StructField("dw_created_at", ts), T.StructField("dw_updated_at", ts)])
    return incoming.sparkSession.createDataFrame([], T.StructType(fields))


def detect_changes(incoming: DataFrame, dim: DataFrame, natural_key="customer_id",
                   tracked=None, valid_from_col: str = "updated_at",
                   literal_hash: bool = False) -> DataFrame:
    """Incoming rows that are new keys or differ from the current version.

    Adds ``change_type`` ('new' / 'changed'). Left join of incoming to the
    current rows on the natural key, then a hash comparison. With
    ``literal_hash`` the hash is the plain concatenation (cannot tell
    ('ab','c') from ('a','bc')); by default a separated, NULL-marked hash.
    """
    keys = _keys(natural_key)
    tracked = list(tracked or CUSTOMER_TRACKED)
    hf = concat_hash if literal_hash else change_hash
    cur = dim.filter(F.col("is_current")).select(
        *[F.col(k).alias(f"_d_{k}") for k in keys], hf([F.col(c) for c in tracked]).alias("_d_h"))
    inc = incoming.withColumn("_i_h", hf([F.col(c) for c in tracked]))
    cond = [inc[k] == cur[f"_d_{k}"] for k in keys]
    j = inc.join(cur, cond, "left")
    is_new = F.col(f"_d_{keys[0]}").isNull()
    out = j.filter(is_new | (F.col("_i_h") != F.col("_d_h")))
    return out.withColumn("change_type", F.when(is_new, "new").otherwise("changed")).drop(
        "_i_h", "_d_h", *[f"_d_{k}" for k in keys])


class AmbiguousVersionError(ValueError):
    """Two different rows of one key and timestamp, and no order to choose by."""


def one_row_per_version(incoming: DataFrame, keys: list[str], tracked: list[str], valid_from_col: str,
                        order_by: str | None = None) -> DataFrame:
    """One incoming row per key and timestamp: the latest by ``order_by``.
    Without an order, rows that differ in a tracked attribute raise; rows that
    agree are one (the aggregates combine map-side). The batch is worked out
    once, for that check and the merge; the rows are checkpointed in between."""
    group = [*keys, valid_from_col]
    others = [c for c in incoming.columns if c not in group]
    row = F.struct(*others)
    found = [F.col(f"_r.{c}").alias(c) for c in others]
    if order_by is not None:
        return incoming.groupBy(*group).agg(F.max_by(row, F.col(order_by)).alias("_r")).select(*group, *found)
    h = change_hash(tracked)
    one = incoming.groupBy(*group).agg(F.min_by(row, F.xxhash64(*others)).alias("_r"), (F.min(h) != F.max(h)).alias("_torn")) \
        .select(*group, *found, "_torn").checkpoint(eager=True)
    if not one.filter("_torn").isEmpty():
        raise AmbiguousVersionError(f"several different rows for one {group}; pass order_by to keep the latest")
    return one.drop("_torn")


#: The start of a key's first new version, by which its current one is closed.
FIRST = "_first_from"


class Changes(NamedTuple):
    """What a batch does to a dimension."""

    opened: DataFrame  # versions that open, in the dimension's columns; all but a key's last are closed already
    rejected: DataFrame
    close: Callable[[DataFrame, DataFrame], DataFrame]  # (current rows, key and FIRST of the opened) -> the rows that end


def scd2_changes(dim: DataFrame, incoming: DataFrame, natural_key="customer_id", tracked=None,
                 attributes=None, valid_from_col: str = "updated_at", as_of=None,
                 surrogate: str = "customer_key", max_ts: str = SCD2_MAX_TS, order_by: str | None = None) -> Changes:
    """The versions that a batch opens and ends, by the rules of ``scd2_merge``;
    ``dim`` need only hold the versions of the batch's keys."""
    keys = _keys(natural_key)
    tracked = list(tracked or CUSTOMER_TRACKED)
    attributes = list(attributes or CUSTOMER_ATTRIBUTES)
    now = _ts(as_of) if as_of is not None else F.localtimestamp()
    h = change_hash(tracked)
    one_s = F.expr("INTERVAL 1 SECOND")
    dim_cols = [surrogate, *keys, *attributes, "valid_from", "valid_to", "is_current",
                "dw_created_at", "dw_updated_at"]

    incoming = one_row_per_version(incoming, keys, tracked, valid_from_col, order_by)
    inc = incoming.select(*keys, *attributes, F.col(valid_from_col).alias("valid_from")).withColumn("_h", h)
    known = dim.select(*keys, "valid_from", h.alias("_h"))
    inc = inc.join(known, [*keys, "valid_from", "_h"], "left_anti")

    cur = dim.filter(F.col("is_current")).select(
        *keys, F.col("valid_from").alias("_cur_from"), h.alias("_cur_h"))
    inc = inc.join(cur, keys, "left")
    late = F.col("_cur_from").isNotNull() & (F.col("valid_from") <= F.col("_cur_from"))
    # a late row is harmless when it agrees with the version in force at its
    # time (e.g. a row the original run collapsed); it is rejected when it
    # contradicts that version or predates the key's history
    was = dim.select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("valid_from").alias("_w_from"),
                     (F.col("valid_to") + one_s).alias("_w_to"), h.alias("_w_h"))
    lr = inc.filter(late)
    cond = [lr[k] == was[f"_w_{k}"] for k in keys] + [
        lr["valid_from"] >= was["_w_from"], lr["valid_from"] < was["_w_to"]]
    rejected = (lr.join(was, cond, "left")
                .filter(F.col("_w_h").isNull() | (F.col("_w_h") != F.col("_h")))
                .select(*keys, *attributes, "valid_from"))

    cand = inc.filter(~late | F.col("_cur_from").isNull())
    cand = with_neighbours(cand, keys, "valid_from", prev_cols=["_h"])
    cand = cand.withColumn("_prev", F.coalesce(F.col("_prev__h"), F.col("_cur_h")))
    opened = cand.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("_h")))
    opened = with_neighbours(opened.drop("_prev__h", "_prev"), keys, "valid_from", next_cols=["valid_from"])
    nxt = F.col("_next_valid_from")
    opened = opened.select(
        surrogate_key(*keys, "valid_from").alias(surrogate), *keys, *attributes, "valid_from",
        F.coalesce(nxt - one_s, _ts(max_ts)).alias("valid_to"),
        nxt.isNull().alias("is_current"),
        now.alias("dw_created_at"), now.alias("dw_updated_at"),
    )

    def close(cur_rows: DataFrame, firsts: DataFrame) -> DataFrame:
        return cur_rows.join(firsts, keys, "inner").select(
            *[c for c in dim_cols if c not in ("valid_to", "is_current", "dw_updated_at")],
            (F.col(FIRST) - one_s).alias("valid_to"),
            F.lit(False).alias("is_current"),
            now.alias("dw_updated_at"),
        ).select(*dim_cols)

    return Changes(opened.select(*dim_cols), rejected, close)


def scd2_merge(dim: DataFrame, incoming: DataFrame, natural_key="customer_id", **kw):
    """Apply one incoming batch to a type-2 dimension.

    Returns ``(new_dim, rejected)``.

    - A key absent from the dimension opens its first version.
    - A key whose tracked attributes differ from the current version closes
      it at ``next_from - 1 s`` and opens a new one.
    - Several changes of one key in one batch open several versions, each
      closed by the next; consecutive equal rows collapse.
    - Rows already applied (same key, start and attributes) and rows equal
      to the version they would follow are ignored, so a rerun is a no-op.
    - A changed row dated at or before the current version's start cannot
      be applied without rewriting history; it is returned in ``rejected``.
    - Different rows of one key and timestamp raise, or the latest by
      ``order_by`` is taken.
    """
    keys = _keys(natural_key)
    ch = scd2_changes(dim, incoming, natural_key, **kw)
    firsts = ch.opened.groupBy(*keys).agg(F.min("valid_from").alias(FIRST))
    d = dim.select(*ch.opened.columns)
    cur_rows = d.filter(F.col("is_current"))
    untouched = d.filter(~F.col("is_current")).unionByName(cur_rows.join(firsts, keys, "left_anti"))
    return untouched.unionByName(ch.close(cur_rows, firsts)).unionByName(ch.opened), ch.rejected


def merge_batches(dim: DataFrame, batches, checkpoint: bool = True, **merge_kw):
    """Apply batches in order; returns ``(dim, [rejected per batch])``.

    Each step's result is checkpointed to the shared checkpoint folder
    (the table a pipeline cycle would write), so step n's plan is a scan of
    step n-1's output, not its whole lineage: a merge refers to the current
    dimension several times, and unmaterialised steps would grow the plan
    geometrically.
    """
    rejected = []
    if checkpoint:
        from starloom.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(dim.sparkSession)
    for b in batches:
        dim, rej = scd2_merge(dim, b, **merge_kw)
        if checkpoint:
            dim = dim.checkpoint(eager=True)
        rejected.append(rej)
    return dim, rejected


def latest_per_key(feed: DataFrame, natural_key="customer_id", ts_col: str = "updated_at",
                   before=None) -> DataFrame:
    """Latest feed row per key (optionally strictly before ``before``).

    ``max_by`` over a struct aggregates map-side first, so a key with a huge
    number of rows does not land whole in one task.
    """
    keys = _keys(natural_key)
    f = feed if before is None else feed.filter(F.col(ts_col) < _ts(before))
    others = [c for c in f.columns if c not in keys]
    agg = f.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(ts_col)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def as_of_lookup(dim: DataFrame, instant, convention: str = CONTIGUOUS) -> DataFrame:
    """Versions valid at ``instant`` (half-open interval, see ``pit_upper``)."""
    t = _ts(instant)
    return dim.filter((F.col("valid_from") <= t) & (t < pit_upper(F.col("valid_to"), convention)))


def pit_upper(valid_to, convention: str = CONTIGUOUS):
    """Exclusive upper bound of a version for point-in-time matching."""
    if convention == CONTIGUOUS:
        return valid_to
    if convention == MINUS_1S:
        return valid_to + F.expr("INTERVAL 1 SECOND")
    raise ValueError(f"unknown interval convention {convention!r}")
