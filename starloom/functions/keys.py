"""Surrogate keys and change hashes (column expressions, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.params import KEY_NULL_MARKER, KEY_SEPARATOR


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 of the key columns as strings, joined by a separator; NULL -> marker.

    Deterministic across runs and executors (no counters), so a rerun gives
    the same key and a distributed job needs no coordination.
    """
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(KEY_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def change_hash(cols) -> Column:
    """Hash of tracked attributes used to detect a changed version.

    Unlike a bare concatenation, the separator and NULL marker keep
    ('ab','c') apart from ('a','bc') and NULL apart from ''.
    """
    return surrogate_key(*cols)


def concat_hash(cols) -> Column:
    """The literal form: md5 of the concatenation with NULL read as ''.

    Kept for parity with a plain ``MD5(CONCAT(COALESCE(c, '')...))``; it
    cannot tell ('ab','c') from ('a','bc').
    """
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat(*parts))
