"""Best-fit packing (operator 7): exact-complement hashing over lengths.

Documents become token ids (with an end id); only those longer than a
sequence are cut. What remains to pack is a histogram with at most ``cap``
lengths, whatever the number of documents, so the packing is planned on it:
from the longest length down, the gap it leaves is looked up among the single
lengths, the sums of pairs and of triples that are still available, and as
many sequences are filled exactly as the availability counts allow. Lengths
without an exact complement are packed best-fit, longest first. The plan says
for each length which of its pieces (by rank) go to which sequences at which
offset; ranks are counted per length and input partition, so that one very
frequent length is never gathered.

Defined results: a null text is an empty text (only the end id). An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import settle, with_added_tokens, worker_held

CAP = 2048
END_ID = 0


class WordIds(dict):
    """The id bytes of words, each worked out once while a Python worker holds it.

    White space is dropped and ASCII letters are lower-cased by the tokenizer,
    and a pre-token of letters ends before a full stop or comma; so a word's ids
    come from its lower-cased form, or from its letters and its last sign. A word
    of ASCII letters is a single pre-token and goes straight to the model. All
    other words go through the whole tokenizer. When LIMIT words are held, they
    are dropped; long ones are not held.
    """

    LIMIT, LONG = 500_000, 64

    def __init__(self, tok: Tokenizer):
        super().__init__()
        self.tok, self.model = tok, tok.model

    def __missing__(self, word: bytes) -> bytes:
        lower = word.lower()
        if lower != word and word.isascii():
            ids = self[lower]
        elif word[-1:] in (b".", b",") and word[:-1].isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        elif word.isalpha():
            ids = np.array([t.id for t in self.model.tokenize(word.decode())], "<u4").tobytes()
        else:
            ids = np.array(self.tok.encode(word.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= self.LONG:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = ids
        return ids


def word_encoder(tokenizer_json: str):
    """A function from text to id bytes, for a lower-casing tokenizer that drops white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_str(tokenizer_json)
    tok.encode_special_tokens = True  # what lower-casing makes of a word is no added token
    ids_of = WordIds(tok).__getitem__
    return with_added_tokens(tok, "<u4", lambda text: b"".join(map(ids_of, text.encode("utf-8", "surrogatepass").split())))


def cut_pieces(docs: DataFrame, tokenizer_path: str, cap: int = CAP, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids) of every piece of every document."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    held = ("words", hashlib.sha256(tokenizer_json.encode()).hexdigest())
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def run(batches):
        encode = worker_held(held, lambda: word_encoder(tokenizer_json))
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * cap)):
                    part = ids[at:at + 4 * cap]
                    rows.append((doc, k, k * cap, len(part) // 4, zlib.crc32(part), part)[:len(names)])
            cols = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Complements:
    """Available lengths, and combinations of one to three of them with a given sum."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)

    def times(self, combo: tuple[int, ...]) -> int:
        """How often the combination can be taken."""
        return min(int(self.left[x]) // combo.count(x) for x in combo)

    def pair(self, total: int) -> tuple[int, int] | None:
        """The pair with this sum that can be taken most often."""
        if total < 2:
            return None
        low = self.left[1:total // 2 + 1]
        high = self.left[total - len(low):total][::-1]
        often = np.minimum(low, high)
        if total % 2 == 0:
            often[-1] = low[-1] // 2
        at = int(often.argmax())
        return (total - at - 1, at + 1) if often[at] > 0 else None

    def exact(self, first: int, gap: int) -> tuple[int, ...] | None:
        """The first length and at most three more that fill its gap exactly."""
        if gap == 0:
            return (first,)
        self.left[first] -= 1
        try:
            if self.left[gap] > 0:
                return (first, gap)
            if found := self.pair(gap):
                return (first, *found)
            for c in np.flatnonzero(self.left[:gap - 1])[::-1].tolist():
                self.left[c] -= 1
                found = self.pair(gap - c)
                self.left[c] += 1
                if found:
                    return (first, c, *found)
            return None
        finally:
            self.left[first] += 1


def plan_packing(histogram: dict[int, int], cap: int = CAP) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and the number of sequences each fills."""
    counts = np.zeros(cap + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    table, rest = Complements(counts), []
    patterns: list[tuple[tuple[int, ...], int]] = []
    for length in range(cap, 0, -1):
        while table.left[length] > 0:
            combo = table.exact(length, cap - length)
            if combo is None:
                rest.append((length, int(table.left[length])))
                table.left[length] = 0
                break
            n = table.times(combo)
            for x in combo:
                table.left[x] -= n
            patterns.append((combo, n))
    open_bins: dict[int, list] = {}  # by gap: [pattern, number]
    for length, n in rest:
        while n > 0:
            gap = min((g for g, bins in open_bins.items() if g >= length and bins), default=None)
            if gap is None:
                each = min(cap // length, n)
                pattern, bins = (length,) * each, n // each
                room = cap - each * length
            else:
                old, free = open_bins[gap].pop()
                each = min(gap // length, n)
                bins = min(free, n // each)
                if free > bins:
                    open_bins[gap].append((old, free - bins))
                pattern, room = old + (length,) * each, gap - each * length
            open_bins.setdefault(room, []).append((pattern, bins))
            n -= each * bins
    return patterns + [b for bins in open_bins.values() for b in bins]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Runs of places, by (length, first rank): the run's first sequence and its offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for combo, n in patterns:
        offset = 0
        for length in combo:
            rank = used.get(length, 0)
            rows.append((length, rank, base, offset))
            used[length] = rank + n
            offset += length
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T.copy()))


def place(pieces: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``cap``."""
    pieces = settle(pieces.withColumn("__row", F.monotonically_increasing_id()))
    numbered = pieces.withColumn("__part", F.shiftright("__row", 33))
    by_part = settle(numbered.groupBy("length", "__part").agg(F.count("*").alias("__n")))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # at most cap rows
    plan = slots(plan_packing(histogram, cap))
    before = by_part.withColumn("__before", F.sum("__n").over(Window.partitionBy("length").orderBy("__part")) - F.col("__n"))
    inside = F.row_number().over(Window.partitionBy("length", "__part").orderBy("__row")) - 1
    ranked = numbered.join(before.select("length", "__part", "__before"), ["length", "__part"]) \
        .withColumn("__rank", F.col("__before") + inside)
    most = int(plan["rank"].max(initial=0)) + 1
    keys = plan["length"].astype(object) * most + plan["rank"] if len(plan["rank"]) else np.array([], object)
    wide = bool(len(keys)) and int(keys.max()) > 2**62
    if wide:
        raise OverflowError("more pieces of one length than a 64-bit place number holds")
    keys = keys.astype(np.int64)

    @F.pandas_udf("sequence_id long, offset long")
    def found(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy() * most + np.minimum(rank.to_numpy(), most - 1), side="right") - 1
        return pd.DataFrame({"sequence_id": plan["sequence"][at] + rank.to_numpy() - plan["rank"][at], "offset": plan["offset"][at]})

    return ranked.withColumn("__at", found("length", "__rank")) \
        .select(*[c for c in pieces.columns if c != "__row"], "__at.sequence_id", "__at.offset")


def pack(docs: DataFrame, tokenizer_path: str, cap: int = CAP, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with their places."""
    return place(cut_pieces(docs, tokenizer_path, cap, end_id), cap)
