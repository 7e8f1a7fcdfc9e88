"""Approximate nearest neighbours (operator 10): HNSW graphs per shard.

Equal vectors become one node that carries its smallest ids (as many as any
result can need). Nodes are dealt by hash into shards of a bounded size; each
shard's hierarchical navigable small-world graph is built in one task and kept
as flat arrays: the vectors, and per layer the node numbers and a fixed-width
neighbour table. As shards are bounded, a node's link candidates are its exact
nearest ones among the layer's nodes; links are chosen by the usual rule (a
candidate is kept if it is nearer to the node than to every neighbour kept
before) and made two-way within the width. A search descends from the top layer
and runs a beam over the lowest one, for a block of queries at a time. The
shards' results are merged by exact distance on the original vectors.

Defined results: vectors that are null, zero, or hold a null or a non-finite
component, and rows without an id, take no part. Repeated rows of one id and
vector count once. Fewer candidates than ``k`` give fewer results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import settle

K = 10
SHARD_NODES = 4096
LINKS = 16
WIDTH = 32          # neighbours a node of the lowest layer can have
CANDIDATES = 64     # nearest ones that links are chosen from
BEAM = 192
TOP_BEAM = 8
QUERY_BLOCK = 512
INDEX_SCHEMA = "shard int, n int, ids array<array<long>>, vectors binary, layers array<binary>, links array<binary>"


def sound(vector: str) -> F.Column:
    """Whether a vector takes part."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def choose_links(vectors: np.ndarray, members: np.ndarray, links: int, width: int) -> np.ndarray:
    """Neighbour table (node numbers, -1 where empty) of one layer's members."""
    n = len(members)
    own = vectors[members]
    norms = (own * own).sum(1)
    pick = min(CANDIDATES, n - 1)
    if pick < 1:
        return np.full((n, width), -1, np.int32)
    edges_from, edges_to, edges_far = [], [], []
    for at in range(0, n, 512):
        rows = np.arange(at, min(n, at + 512))
        far = norms[rows, None] + norms[None] - 2 * own[rows] @ own.T
        far[np.arange(len(rows)), rows] = np.inf
        near = np.argpartition(far, pick - 1, axis=1)[:, :pick]
        near_far = np.take_along_axis(far, near, 1)
        order = np.lexsort((near, near_far), axis=1)
        near, near_far = np.take_along_axis(near, order, 1), np.take_along_axis(near_far, order, 1)
        c = own[near]
        between = norms[near][:, :, None] + norms[near][:, None, :] - 2 * c @ c.transpose(0, 2, 1)
        kept = np.zeros((len(rows), pick), bool)
        for j in range(pick):
            blocked = (kept & (between[:, j, :] < near_far[:, j, None])).any(1)
            kept[:, j] = ~blocked & (kept.sum(1) < links)
        i, j = np.nonzero(kept)
        edges_from.append(rows[i])
        edges_to.append(near[i, j])
        edges_far.append(near_far[i, j])
    a, b, far = (np.concatenate(x) for x in (edges_from, edges_to, edges_far))
    # own links first, then the nearest of those that others made to this node
    node, other = np.concatenate([a, b]), np.concatenate([b, a])
    back, far = np.repeat([0, 1], len(a)), np.concatenate([far, far])
    _, once = np.unique(node * n + other, return_index=True)  # an own link comes before the same one back
    node, other, back, far = node[once], other[once], back[once], far[once]
    order = np.lexsort((far, back, node))
    node, other = node[order], other[order]
    place = np.arange(len(node)) - np.searchsorted(node, node)
    table = np.full((n, width), -1, np.int32)
    fits = place < width
    table[node[fits], place[fits]] = members[other[fits]]
    return table


def build_graph(vectors: np.ndarray, draws: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Members and neighbour table of each layer, lowest first. draws: uniform in (0, 1], one per node."""
    level = np.floor(-np.log(draws) / math.log(LINKS)).astype(int)
    layers, links = [], []
    for at in range(int(level.max()) + 1):
        members = np.flatnonzero(level >= at).astype(np.int32)
        layers.append(members)
        links.append(choose_links(vectors, members, LINKS, WIDTH if at == 0 else LINKS))
    return layers, links


def beam_search(vectors: np.ndarray, norms: np.ndarray, members: np.ndarray, table: np.ndarray, queries: np.ndarray,
                entry: np.ndarray, beam: int) -> np.ndarray:
    """The ``beam`` nearest nodes that the layer's graph leads each query to (-1 where fewer), nearest first."""
    n, q = len(vectors), len(queries)
    row_of = np.full(n, -1, np.int64)
    row_of[members] = np.arange(len(members))
    seen = np.zeros((q, n + 1), bool)  # the last column stands for the empty place -1
    seen[:, -1] = True
    rows = np.arange(q)[:, None]

    def distance(ids):
        far = norms[ids] - 2 * np.einsum("qkd,qd->qk", vectors[ids], queries)
        return np.where(ids < 0, np.inf, far)

    ids = np.full((q, beam), -1, np.int64)
    far = np.full((q, beam), np.inf)
    done = np.ones((q, beam), bool)
    width = min(beam, entry.shape[1])
    ids[:, :width] = entry[:, :width]
    far[:, :width] = distance(ids[:, :width])
    done[:, :width] = ids[:, :width] < 0
    seen[rows, ids] = True
    step = 4  # nodes of each beam that are opened at once
    while not done.all():
        order = np.argsort(np.where(done, np.inf, far), axis=1, kind="stable")[:, :step]
        opened = np.where(np.take_along_axis(done, order, 1), -1, np.take_along_axis(ids, order, 1))
        np.put_along_axis(done, order, True, 1)
        next_ids = np.where(opened[:, :, None] >= 0, table[row_of[opened]], -1).reshape(q, -1).astype(np.int64)
        next_ids = np.sort(next_ids, axis=1)
        again = np.zeros_like(next_ids, bool)
        again[:, 1:] = next_ids[:, 1:] == next_ids[:, :-1]
        next_ids = np.where(again | seen[rows, next_ids], -1, next_ids)
        seen[rows, next_ids] = True
        all_ids = np.concatenate([ids, next_ids], 1)
        all_far = np.concatenate([far, distance(next_ids)], 1)
        all_done = np.concatenate([done, next_ids < 0], 1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids, far, done = (np.take_along_axis(x, order, 1) for x in (all_ids, all_far, all_done))
    return ids


def search_graph(vectors, layers, links, queries, beam: int = BEAM) -> np.ndarray:
    norms = (vectors * vectors).sum(1)
    entry = np.broadcast_to(layers[-1][:TOP_BEAM].astype(np.int64), (len(queries), len(layers[-1][:TOP_BEAM])))
    for members, table in zip(layers[:0:-1], links[:0:-1]):
        entry = beam_search(vectors, norms, members, table, queries, entry, TOP_BEAM)
    return beam_search(vectors, norms, layers[0], links[0], queries, entry, beam)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per shard (INDEX_SCHEMA), of all sound vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & sound("v")).dropDuplicates()
    # k + 1 ids: a query may be one of them
    first = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("at") <= k + 1)
    nodes = settle(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    n_shards = max(1, math.ceil(nodes.count() / shard_nodes))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(n_shards)).cast("int")) \
        .withColumn("draw", (F.pmod(F.xxhash64(F.element_at("ids", 1), F.lit("level")), F.lit(1 << 30)) + 1) / float(1 << 30))

    def build(key, table):
        table = table.sort_by("first")
        v = np.array(table.column("v").to_pylist(), float)
        layers, links = build_graph(v, table.column("draw").to_numpy())
        row = {"shard": [key[0].as_py()], "n": [len(v)], "ids": [table.column("ids").to_pylist()], "vectors": [v.tobytes()],
               "layers": [[x.tobytes() for x in layers]], "links": [[x.tobytes() for x in links]]}
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()))
        return pa.table({c: pa.array(x, t) for (c, x), t in zip(row.items(), kinds)})

    return dealt.withColumn("first", F.element_at("ids", 1)).groupBy("shard").applyInArrow(build, INDEX_SCHEMA)


def search(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, itself left out."""
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("query_id").isNotNull() & sound("v")).groupBy("query_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    n_shards = index.agg(F.max("shard")).first()[0]
    shards = F.sequence(F.lit(0), F.lit(-1 if n_shards is None else n_shards)) if n_shards is not None else F.array().cast("array<int>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")).withColumn("shard", F.explode(shards))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    schema = "query_id long, vec_id long, score double"
    kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}

    def run(key, own, graph):
        if not len(own) or not len(graph):
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        g = graph.to_pylist()[0]
        vectors = np.frombuffer(g["vectors"]).reshape(g["n"], -1)
        layers = [np.frombuffer(x, np.int32) for x in g["layers"]]
        links = [np.frombuffer(x, np.int32).reshape(len(m), -1) for x, m in zip(g["links"], layers)]
        q = np.array(own.column("v").to_pylist(), float)
        near = search_graph(vectors, layers, links, q, beam)
        out = ([], [], [])
        for query, row, at in zip(own.column("query_id").to_pylist(), q, near):
            at = at[at >= 0]
            score = np.sqrt(((vectors[at] - row) ** 2).sum(1))
            found = sorted((s, i) for s, node in zip(score.tolist(), at.tolist()) for i in g["ids"][node] if i != query)[:k]
            for s, i in found:
                out[0].append(query)
                out[1].append(i)
                out[2].append(s)
        return pa.table({c: pa.array(x, t) for (c, t), x in zip(kinds.items(), out)})

    found = asked.groupBy("shard", "block").cogroup(index.groupBy("shard", "block")).applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
