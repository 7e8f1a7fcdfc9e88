"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from starloom.session import ensure_checkpoint_dir, scratch_path


#: A new folder in the shared checkpoint folder for a written table.
shared_path = scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    What earlier steps shuffled is garbage by then; Spark's cleaner deletes it
    once the driver's JVM has collected, so that is asked for here and a chain
    of steps does not pile up on the disks.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.checkpoint()


def worker_held(key, make):
    """What ``make`` gives, held by this Python worker for its later tasks under ``key``.

    Functions of this package are pickled by value, so their module's globals
    are new in every task; the interpreter's ``sys`` is not.
    """
    held = sys.__dict__.setdefault("_starloom_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def with_added_tokens(tok, kind: str, encode):
    """``encode``, but with the added tokens of ``tok`` found in the text first, as a plain call of the tokenizer does."""
    known = tok.get_added_tokens_decoder()
    if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in known.values()):
        raise ValueError("added tokens that depend on the text around them")
    ids = {t.content: np.array([i], kind).tobytes() for i, t in known.items()}
    cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(ids, key=len, reverse=True)) + ")")

    def whole(text: str) -> bytes:
        if not any(x in text for x in ids):
            return encode(text)
        return b"".join(ids[x] if x in ids else encode(x) for x in cut.split(text) if x)

    return whole


class Memo:
    """Remembers what ``fill`` gave for a key, within a bound.

    Two generations of entries: when the young one holds ``limit`` characters
    (plus a fixed cost per entry) it becomes the old one, and entries that are
    still wanted move back. The bound holds up to the keys of one call.
    """

    ENTRY_COST = 24

    def __init__(self, fill, limit: int = 6_000_000):
        self.fill, self.limit = fill, limit
        self.young, self.old, self.size = {}, {}, 0

    def look(self, keys: list):
        """The values of all keys, in order."""
        need = set(keys).difference(self.young)
        if need:
            if self.size > self.limit:
                self.old, self.young, self.size, need = self.young, {}, 0, set(keys)
            fresh = []
            for k in need:
                v = self.old.get(k)
                if v is None:
                    fresh.append(k)
                else:
                    self.young[k] = v
            if fresh:
                self.young.update(zip(fresh, self.fill(fresh)))
            self.size += sum(map(len, need)) + self.ENTRY_COST * len(need)
        return map(self.young.__getitem__, keys)
