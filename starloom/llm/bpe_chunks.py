"""Byte-level BPE (operator 2): overlapping chunk encoding, and decoding.

Texts of up to ``step`` characters are one chunk and are encoded where they
are read. Longer texts are cut into chunks of ``step`` characters plus
``overlap`` characters of the next, dealt out to all tasks and pre-tokenised
apart from each other. Each chunk reports the pre-token boundaries of its head
and its tail. The pattern looks ahead but never back, so once two chunks share
a boundary they go on alike: the first common boundary after a non-space
character is where they are stitched. The pieces between stitches are encoded
by the merge ranks and put in order. From chunks without a common boundary on
(one pre-token longer than the overlap), the rest of the text is one piece.

Ids travel as little-endian unsigned 32-bit arrays. Decoding concatenates the
raw bytes of the ids.

Defined results: a null text is an empty text (no ids). Rows stand for
themselves, so repeated ids or rows give one result each.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import Memo

STEP = 16384
OVERLAP = 512
# A boundary this close to a chunk's end may still hang on text beyond it.
MARGIN = 4


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def compile_pattern(pattern: str):
    # the rank files' patterns mean Unicode's White_Space by \s
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


def make_encoder(ranks: dict[bytes, int], pattern: str):
    """A function from text to id bytes: pre-tokens, each encoded once per task."""
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    split = compile_pattern(pattern).findall
    memo = Memo(lambda keys: [np.array(enc.encode_ordinary(k), "<u4").tobytes() for k in keys])
    return lambda text: b"".join(memo.look(split(text)))


def boundaries(text: str, start: int, split) -> np.ndarray:
    """Places in the whole text where a pre-token of this chunk ends after a non-space character."""
    tokens = split(text)
    ends = np.cumsum([len(t) for t in tokens])
    solid = np.array([not t[-1].isspace() for t in tokens], bool)
    return (ends[solid & (ends <= len(text) - MARGIN)] + start).astype(np.int64)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           step: int = STEP, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and its ids (binary, unsigned 32-bit little-endian)."""
    ranks = load_ranks(ranks_path)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode_rows(batches):
        encoder = make_encoder(ranks, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([encoder(t.as_py()) for t in b.column(1)], pa.binary())], ["doc_id", "ids"])

    short = docs.where(F.length("text") <= step).mapInArrow(encode_rows, "doc_id long, ids binary")
    pieces = stitched_pieces(docs.where(F.length("text") > step), pattern, step, overlap)

    def encode_pieces(batches):
        encoder = make_encoder(ranks, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([encoder(t.as_py()) for t in b.column(3)], pa.binary())],
                ["row", "doc_id", "place", "ids"])

    def assemble(key, table):
        order = np.argsort(table.column("place").to_numpy())
        parts = table.column("ids").to_pylist()
        return pa.table({"doc_id": table.column("doc_id").slice(0, 1), "ids": pa.array([b"".join(parts[i] for i in order)], pa.binary())})

    long = pieces.mapInArrow(encode_pieces, "row long, doc_id long, place long, ids binary") \
        .groupBy("row").applyInArrow(assemble, "doc_id long, ids binary")
    return short.unionByName(long)


def stitched_pieces(docs: DataFrame, pattern: str, step: int, overlap: int) -> DataFrame:
    """row, doc_id, place, text: consecutive pieces of each long text, cut only at true pre-token boundaries."""

    def cut(batches):
        for b in batches:
            rows, ids, texts = (c.to_pylist() for c in b.columns)
            for row, doc, text in zip(rows, ids, texts):
                starts = range(0, len(text), step)
                yield pa.RecordBatch.from_pydict(
                    {"row": [row] * len(starts), "doc_id": [doc] * len(starts), "chunk": list(range(len(starts))),
                     "text": [text[s:s + step + overlap] for s in starts]},
                    schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string())]))

    def ends(batches):
        split = compile_pattern(pattern).findall
        for b in batches:
            head, tail = [], []
            for c, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                at = boundaries(t, c * step, split)
                head.append(at[at <= c * step + overlap])
                tail.append(at[at > (c + 1) * step])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(head, kind), pa.array(tail, kind)],
                                             ["row", "doc_id", "chunk", "text", "head", "tail"])

    keys = "row long, doc_id long, chunk long, text string"
    chunks = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text").mapInArrow(cut, keys) \
        .repartition("row", "chunk").mapInArrow(ends, keys + ", head array<long>, tail array<long>")
    # one row per chunk and neighbour: a chunk meets the tail of the one before and the head of the next
    w = Window.partitionBy("row").orderBy("chunk")
    met = chunks.withColumns({
        "start": F.array_min(F.array_intersect("head", F.lag("tail").over(w))),
        "stop": F.array_min(F.array_intersect("tail", F.lead("head").over(w))),
        "last": F.lead("chunk").over(w).isNull()})
    # the run of chunks up to the next stitch; nearly always a single chunk. A chunk's boundaries are only
    # known to be right if it was stitched itself, so after the first unstitched chunk all belong to one run
    met = met.withColumn("sure", F.min((F.col("chunk") == 0) | F.col("start").isNotNull()).over(w)) \
        .withColumn("run", F.count(F.when(F.col("sure"), 1)).over(w))

    def join_run(key, table):
        t = table.sort_by("chunk").to_pydict()
        first, whole = t["chunk"][0], t["text"][0]
        for c, x in zip(t["chunk"][1:], t["text"][1:]):
            whole = whole[:(c - first) * step] + x
        a = 0 if first == 0 else t["start"][0] - first * step
        z = len(whole) if t["last"][-1] else t["stop"][-1] - first * step
        return pa.table({"row": [t["row"][0]], "doc_id": pa.array([t["doc_id"][0]], pa.int64()), "place": [first], "text": [whole[a:z]]})

    return met.select("row", "doc_id", "chunk", "text", "start", "stop", "last", "run").groupBy("row", "run") \
        .applyInArrow(join_run, "row long, doc_id long, place long, text string")


def decode(ids: bytes, words: list[bytes]) -> bytes:
    return b"".join(map(words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    words = [b""] * (max(ranks.values()) + 1)
    for w, i in ranks.items():
        words[i] = w
    return words


def decode_table(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the decoded bytes of each row of :func:`encode`."""
    words = token_bytes(load_ranks(ranks_path))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x.as_py(), words) for x in b.column(1)], pa.binary())],
                                             ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids, one space between), decoded_sha256 (bytes that the ids give back)."""
    words = token_bytes(load_ranks(ranks_path))

    def run(batches):
        decimal = [b"%d" % i for i in range(len(words))]
        for b in batches:
            counts, shas, back = [], [], []
            for x in b.column(1):
                ids = np.frombuffer(x.as_py(), "<u4").tolist()
                counts.append(len(ids))
                shas.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                back.append(hashlib.sha256(b"".join(map(words.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
