"""MinHash near-dedup (operator 4): an inverted join over signature coordinates.

A document's set is its distinct 5-word shingles (lower-cased A-Z). Documents of
equal sets become one node (the smallest id); a signature of COORDINATES (64)
minimum hashes is posted under each (coordinate, value). Two sets of similarity
0.75 agree in 48 of 64 coordinates on average; pairs that agree in fewer than
MATCHES (26) are not looked at, which a linked pair does with a probability
below 1e-8.

Prefix and skip: values that only one node has are skipped, so are nodes left
with fewer than MATCHES values. Of the others' m values, the m - MATCHES + 1
rarest must hold one that a partner shares; only those prefixes are joined.
Very frequent values are seldom in a prefix, except in groups of near copies.
So instead of all pairs, every posting list compares its members with its hub,
the member with the most shared values. Pairs are held against MATCHES on whole
signatures, then confirmed on the full sets. Members of lists that are still in
several components are then joined exactly: of a set of n shingles, the rarest
n - ceil(3n/4) + 1 must hold one of a linked partner's (for the smaller set of a
pair, n - ceil(6n/7) + 1), and the places of that shingle in both orders must
leave room for the overlap that 0.75 asks for. Frequent shingles come last in
those orders, so no group's pairs are enumerated, and no link is lost.

Defined results: null, empty and wordless texts have an empty set, are linked
with nothing and kept. Rows with a null id are linked with nothing and kept;
rows that share an id count as one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settle
from starloom.llm.components import components
from starloom.llm.substring_cover import rolling, word_hashes

WIDTH = 5
SIMILARITY_PCT = 75
COORDINATES = 64
MATCHES = 26
SEED = 20240229


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if len(words) >= WIDTH:
        return np.unique(rolling(words, WIDTH))
    return rolling(words, len(words)) ^ np.uint64(len(words)) if len(words) else words


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED).integers(0, 1 << 63, (2, COORDINATES, 1), np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signature(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each coordinate its number (upper 8 bits) and smallest hash (56 bits)."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 1024):
        least = np.minimum(least, (a * h[None, at:at + 1024] + b).min(1))
    return ((least >> np.uint64(8)) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(56))).astype(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set), sig of (doc_id, text) rows."""

    def run(batches):
        a, b = multipliers()
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for t in batch.column(1):
                h = shingles(t.as_py())
                sizes.append(len(h))
                keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                sigs.append(signature(h, a, b) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "sig"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """node, sig, shingles of (doc_id, text) rows."""

    def run(batches):
        a, b = multipliers()
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signature(h, a, b) for h in sets], kind),
                                              pa.array([h.view(np.int64) for h in sets], kind)], ["node", "sig", "shingles"])

    return docs.mapInArrow(run, "node long, sig array<long>, shingles array<long>")


def prefixes(nodes: DataFrame) -> DataFrame:
    """node, shared, value: the rarest shared values of each node that has enough of them, and how many it shares."""
    posts = nodes.select("node", F.explode("sig").alias("value"))
    often = posts.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    own = posts.join(often, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("own"))
    return own.where(F.size("own") >= MATCHES) \
        .select("node", F.size("own").alias("shared"), F.explode(F.slice("own", F.lit(1), F.size("own") - MATCHES + 1)).alias("p")) \
        .select("node", "shared", F.col("p.value").alias("value"))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in enough coordinates and whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(left, "a").join(right, "b") \
        .where(F.size(F.array_intersect("sig_a", "sig_b")) >= MATCHES) \
        .where(100 * both >= SIMILARITY_PCT * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")


def ordered(pairs: DataFrame, x, y) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def exact_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different label that may be similar enough, from (node, label, shingles): the prefix join."""
    n = F.size("shingles")
    items = sets.select("node", "label", F.xxhash64("shingles").alias("which"), n.alias("n"), F.explode("shingles").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1")
    shared = items.join(often, "item").groupBy("node", "label", "which", "n").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("own"))
    # shingles that no other set has come first in the order and are not posted
    alone = F.col("n") - F.size("own")
    probe = F.greatest(F.col("n") - F.expr("(3 * n + 3) div 4") + 1 - alone, F.lit(0))
    posts = shared.select("node", "label", "n", alone.alias("alone"), F.posexplode(F.slice("own", F.lit(1), probe)).alias("at", "p")) \
        .select("node", "label", "n", (F.col("alone") + F.col("at")).cast("int").alias("place"), F.col("p.item").alias("item"))
    x = posts.where("place < n - (6 * n + 6) div 7 + 1").alias("x")
    y = posts.alias("y")
    room = F.expr("least(x.n - x.place, y.n - y.place) >= (3 * (x.n + y.n) + 6) div 7")
    smaller = F.expr("x.n < y.n OR (x.n = y.n AND x.node < y.node)")
    close = F.expr("4 * x.n >= 3 * y.n AND x.label <> y.label AND x.node <> y.node")
    return ordered(x.join(y, F.expr("x.item = y.item") & smaller & close & room), F.col("x.node"), F.col("y.node"))


def linked_nodes(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """node, label: the components over all links between nodes that share a prefix value."""
    hub = posts.groupBy("value").agg(F.max(F.struct("shared", (-F.col("node")).alias("node"))).alias("h"), F.count("*").alias("n")) \
        .where("n > 1").select("value", (-F.col("h.node")).alias("hub"))
    found = settle(confirm(ordered(posts.join(hub, "value").where("node <> hub"), "node", "hub"), sets))
    # a node goes by the partner with the most shared values, if that has more than itself: equal names are connected
    shared = posts.select("node", "shared").distinct()
    both = found.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        found.select(F.col("b").alias("node"), F.col("a").alias("other")))
    best = both.join(shared.select(F.col("node").alias("other"), "shared"), "other") \
        .unionByName(shared.select("node", F.col("node").alias("other"), "shared")) \
        .groupBy("node").agg((-F.max(F.struct("shared", (-F.col("other")).alias("other")))["other"]).alias("label"))
    members = settle(posts.select("node", "value").join(best, "node"))
    mixed = members.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("value")
    left = members.join(mixed, "value").select("node", "label").distinct()
    pairs = settle(exact_pairs(sets.join(left, "node").select("node", "label", "shingles")))
    return components(found.unionByName(confirm(pairs, sets)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sigs = settle(signatures(docs))
    nodes = settle(sigs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key")
                   .agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")))
    posts = settle(prefixes(nodes))
    wanted = posts.select(F.col("node").alias("doc_id")).distinct()
    sets = settle(full_sets(docs.join(wanted, "doc_id", "left_semi")))
    labels = linked_nodes(posts, sets)
    named = nodes.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("own"))
    # rows that share an id are one document: the smallest label of theirs
    return sigs.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")) \
        .join(named, "set_key", "left") \
        .select("doc_id", "n_shingles", F.coalesce("own", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that a smaller id of their component stands for, with all their columns."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
