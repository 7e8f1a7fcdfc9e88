"""Substring dedup (operator 5): difference-cover anchors.

A window of WINDOW (13) words that also starts in a document with a smaller id
marks its words for removal. Not every window is exchanged to find them: with a
difference cover D of the residues modulo PERIOD (7), any two places have a
shift below PERIOD that brings both onto residues in D. So two equal windows of
13 words share an *anchor*: 13 - 6 = 7 equal words that start, in both
documents, at a place in D modulo 7. Four steps, all over slices of documents
(about SLICE_CHARS characters each, dealt by hash):

1. each slice posts the distinct hashes of its anchors, 3/7 of all places;
2. per bucket of hashes, those that occur in two documents go back to the slices
   that posted them;
3. each slice extends its shared anchors to the windows around them and posts
   those windows' hashes with the smallest document id; per bucket, the smallest
   id of all goes back to the slices that hold a larger one;
4. each slice marks the windows that a smaller document has, and removes.

A hash that very many documents hold (a frequent passage, a group of copies) is
posted once per slice, not once per document. Slices and buckets have a bounded
size, their numbers follow the input. The three passes over the slices share
one shuffle of the texts. Words and windows are compared by 64-bit hashes.

Defined results: a null text has no words. Rows with a null id neither lose
words nor take any from others. Repeated rows of one id do not affect each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)  # every residue modulo 7 is a difference of two of these
ANCHOR = WINDOW - PERIOD + 1
SLICE_CHARS = 3_000_000
SLICES_A_TASK = 4
BUCKET_POSTS = 1_000_000
FACTOR = 0x9E3779B97F4A7C15  # odd, for polynomial hashes modulo 2**64

POSTS = "bucket int, slice int, hashes binary, firsts binary, several binary"
REPLIES = "slice int, hashes binary, firsts binary"


def word_hashes(raw: bytes) -> np.ndarray:
    words = raw.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, mixed."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h *= np.uint64(FACTOR)
        h += words[k:k + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Slice:
    """The words of a slice's documents, one after the other."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        parts = [word_hashes((t or "").encode("utf-8", "surrogatepass")) for t in texts]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        known = np.array([i is not None for i in ids], bool)
        self.id = np.array([0 if i is None else i for i in ids], np.int64)
        self.usable = known[self.doc] if len(self.doc) else np.zeros(0, bool)
        self.left = self.sizes[self.doc] - (np.arange(len(self.words)) - self.starts[self.doc])  # words from here to the document's end

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (in the slice) and hashes of the anchors."""
        h = rolling(self.words, ANCHOR)
        n = len(h)
        residue = (np.arange(n) - self.starts[self.doc[:n]]) % PERIOD
        at = np.flatnonzero(np.isin(residue, COVER) & (self.left[:n] >= ANCHOR) & self.usable[:n])
        return at, h[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        h = rolling(self.words, WINDOW)
        at = np.flatnonzero((self.left[:len(h)] >= WINDOW) & self.usable[:len(h)])
        return at, h[at]

    def extended(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows that hold a shared anchor."""
        at, h = self.anchors()
        hit = np.zeros(len(self.words) + 1, np.int64)
        hit[at[among(h, shared)]] = 1
        upto = np.concatenate([[0], np.cumsum(hit)])
        places, hashes = self.windows()
        near = upto[places + PERIOD] > upto[places]
        return places[near], hashes[near]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def summary(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, their smallest id, and whether they have several ids."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(hashes)) - 1 if len(at) else at
    return hashes[at], ids[at], ids[at] != ids[ends]


def post(slice_no: int, hashes: np.ndarray, ids: np.ndarray, buckets: int) -> pa.Table:
    """A row for each bucket that gets hashes from this slice."""
    h, first, several = summary(hashes, ids)
    bucket = (h >> np.uint64(33)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    h, first, several, bucket = h[order], first[order], several[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, np.int64)
    rows = [(int(bucket[a]), slice_no, h[a:z].tobytes(), first[a:z].tobytes(), np.packbits(several[a:z]).tobytes())
            for a, z in zip(edges, np.append(edges[1:], len(h)))]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(POSTS.split(", "), cols, kinds)})


def read_posts(table: pa.Table):
    """slice numbers, and (hashes, first ids, several) of each row."""
    slices = table.column("slice").to_pylist()
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    firsts = [np.frombuffer(x, np.int64) for x in table.column("firsts").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8))[:len(h)].astype(bool) for x, h in zip(table.column("several").to_pylist(), hashes)]
    return slices, hashes, firsts, several


def replies(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 3
    return pa.table({"slice": pa.array(cols[0], pa.int32()), "hashes": pa.array(cols[1], pa.binary()), "firsts": pa.array(cols[2], pa.binary())})


def shared_anchors(key, table):
    """Step 2: back to each slice, those of its hashes that two documents have."""
    slices, hashes, firsts, several = read_posts(table)
    every, first = np.concatenate(hashes), np.concatenate(firsts)
    order = np.lexsort((first, every))
    every, first, many = every[order], first[order], np.concatenate(several)[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    group = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(every)) - 1
    known = every[at][(first[at] != first[ends]) | (np.bincount(group, many) > 0)]
    out = [(s, h[among(h, known)].tobytes(), b"") for s, h in zip(slices, hashes)]
    return replies([r for r in out if r[1]])


def first_documents(key, table):
    """Step 3: back to each slice, the smallest id for those of its hashes that it has from a larger one."""
    slices, hashes, firsts, _ = read_posts(table)
    known, first, _ = summary(np.concatenate(hashes), np.concatenate(firsts))
    out = []
    for s, h, own in zip(slices, hashes, firsts):
        best = first[np.searchsorted(known, h)]
        late = best < own
        if late.any():
            out.append((s, h[late].tobytes(), best[late].tobytes()))
    return replies(out)


def gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A slice's replies as sorted hashes and their first ids."""
    h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64)
    f = np.frombuffer(b"".join(table.column("firsts").to_pylist()), np.int64)
    order = np.argsort(h)
    return h[order], f[order] if len(f) == len(h) else f


def removed_words(own: Slice, known: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words of the slice are covered by a window that a smaller document has."""
    places, hashes = own.windows()
    ids = own.id[own.doc[places]]
    mine, least, _ = summary(hashes, ids)
    best = least[np.searchsorted(mine, hashes)] if len(mine) else ids
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        best = np.where(known[at] == hashes, np.minimum(best, first[at]), best)
    late = places[best < ids]
    edge = np.zeros(len(own.words) + 1, np.int64)
    edge[late] += 1
    edge[late + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def with_removals(docs: DataFrame, finish, schema, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``finish(table, keep)`` of every slice; keep gives, row by row, its words (bytes) and a mask of those that stay."""
    total = docs.agg(F.sum(F.length(text_col)).alias("n"), F.count("*").alias("rows")).first()
    n_slices = max(1, -(-(total["n"] or 0) // SLICE_CHARS), -(-total["rows"] // 200_000))
    buckets = max(1, (total["n"] or 0) // 5 * len(COVER) // PERIOD // BUCKET_POSTS + 1)
    names = docs.columns
    at_id, at_text = names.index(id_col), names.index(text_col)
    salt = F.xxhash64(F.col(id_col), F.col(text_col))  # rows of one repeated id are dealt apart
    sliced = docs.withColumn("__slice", F.pmod(salt, F.lit(n_slices)).cast("int"))

    def load(table):
        return Slice(table.column(at_id).cast(pa.int64()).to_pylist(), table.column(at_text).to_pylist())

    def post_anchors(key, table):
        own = load(table)
        at, h = own.anchors()
        return post(key[0].as_py(), h, own.id[own.doc[at]], buckets)

    def post_windows(key, table, shared):
        if not len(table) or not len(shared):
            return post(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), buckets)
        own = load(table)
        places, h = own.extended(gathered(shared)[0])
        return post(key[0].as_py(), h, own.id[own.doc[places]], buckets)

    def remove(key, table, found):
        if not len(table):
            return finish(table, iter(()))
        own = load(table)
        known, first = gathered(found)
        gone = removed_words(own, known, first)
        texts = table.column(at_text).to_pylist()
        return finish(table, (((t or "").encode("utf-8", "surrogatepass").split(), ~gone[a:a + n])
                              for t, a, n in zip(texts, own.starts, own.sizes)))

    # tasks follow the slices and buckets, not the session's shuffle partitions
    slices = sliced.repartition(-(-n_slices // SLICES_A_TASK), "__slice").groupBy("__slice")
    shared = slices.applyInArrow(post_anchors, POSTS).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(shared_anchors, REPLIES)
    firsts = slices.cogroup(shared.groupBy("slice")).applyInArrow(post_windows, POSTS) \
        .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(first_documents, REPLIES)
    return slices.cogroup(firsts.groupBy("slice")).applyInArrow(remove, schema)


def joined(words: list, mask: np.ndarray) -> bytes:
    return b" ".join(words) if mask.all() else b" ".join([w for w, m in zip(words, mask.tolist()) if m])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def finish(table, keep):
        rows = [(len(w), int((~m).sum()), hashlib.sha256(joined(w, m)).hexdigest()) for w, m in keep]
        cols = list(zip(*rows)) if rows else [[]] * 3
        return pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(cols[0], pa.int64()),
                         "n_removed": pa.array(cols[1], pa.int64()), "kept_sha256": pa.array(cols[2], pa.string())})

    return with_removals(docs, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents with their columns, removed words taken out of the text.

    A document that loses nothing keeps its text as it is; one that loses words gets its kept words joined by one
    space, and its new length in ``length_col``; one that loses all its words goes.
    """
    names = docs.columns

    def finish(table, keep):
        table = table.select(names)
        texts, sizes, stays = [], [], []
        for old, (words, mask) in zip(table.column(text_col).to_pylist(), keep):
            whole = bool(mask.all())
            texts.append(old if whole else joined(words, mask).decode("utf-8", "surrogatepass"))
            sizes.append(None if whole else len(texts[-1]))
            stays.append(whole or bool(mask.any()))
        table = table.set_column(names.index(text_col), text_col, pa.array(texts, pa.string()))
        if length_col is not None:
            at = names.index(length_col)
            new = pa.array(sizes, table.schema.field(at).type)
            table = table.set_column(at, length_col, pc.coalesce(new, table.column(at)))
        return table.filter(pa.array(stays, pa.bool_()))

    return with_removals(docs, finish, docs.schema, id_col, text_col)
