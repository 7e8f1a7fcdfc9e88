"""Token-id store (operator 8): one compressed frame per document, one shared dictionary.

A store is a folder of three Parquet tables, written by Spark tasks:

* ``dictionary``: one row with the zstandard dictionary, its sha256, and the
  bytes per id;
* ``blocks``: about a megabyte of frames a row, with the documents' ids, token
  counts and frame offsets (the index), the dictionary's sha256, and the number
  of ids that its part of the table holds before the block;
* ``parts``: the number of ids before each range-ordered part.

A document is read by its block's index and one frame; readers refuse blocks
whose dictionary hash differs. The dictionary is trained on the id arrays of
at most SAMPLE_DOCS documents (those with the least hash of doc_id), of each at
most SAMPLE_IDS ids; everything else covers all documents.

Documents are stored in ascending doc_id order (null ids first, equal ids by a
hash of the text). A null text is an empty text (only the end id). An empty
table gives an empty store. An added token's literal in a text is that token, as
in a plain call of the tokenizer.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import with_added_tokens, worker_held

END_ID = 2
LEVEL = 3
DICTIONARY_BYTES = 65536
SAMPLE_DOCS = 2000
SAMPLE_IDS = 2048
BLOCK_BYTES = 1 << 20

SPACE_AFTER_SPACE = re.compile(r"\s ")
WORD_END = re.compile(r"(?<=\S) ")
#: In UTF-8, all white space but spaces and line feeds has one of these bytes.
OTHER_SPACE = b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"
BLOCK_FIELDS = (("part", pa.int32()), ("ids_before", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                ("frames", pa.binary()), ("dictionary_sha256", pa.string()))
BLOCK_SCHEMA = ("part int, ids_before long, first_doc long, last_doc long, doc_ids array<long>, n_tokens array<long>, "
                "offsets array<long>, frames binary, dictionary_sha256 string")


#: Letters of Latin scripts and the ASCII marks after them: two pre-tokens, whatever follows.
WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")
MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
LAST_LATIN = "\u024f"
#: The byte-level alphabet's characters of bytes that do not stand for themselves.
BYTE_CHARS = {b: chr(256 + n) for n, b in enumerate([*range(33), *range(127, 161), 173])}
#: Latin letters beyond ASCII in that alphabet.
LETTER_CHARS = {n: chr(n).encode().decode("latin-1").translate(BYTE_CHARS) for n in range(0xc0, 0x250)}


class PartIds(dict):
    """The id bytes of parts of a text, each worked out once while it is held.

    A part follows ``lead`` (a space, or nothing). Its pre-tokens end before and
    after a single line break between other characters, and a pre-token of
    letters ends before the marks that end the part, so such parts are put
    together from theirs each time and only those are held (``bare`` holds those
    without a lead), but for SHORT ones, which come often. Latin letters are a single pre-token and go straight to the
    model, in the byte-level alphabet; all else goes through the whole tokenizer.
    When LIMIT parts are held, those held before them are dropped; long ones are
    not held.
    """

    LIMIT, LONG, SHORT = 400_000, 64, 6

    def __init__(self, tok: Tokenizer, width: int, lead: str = "", bare: PartIds | None = None):
        super().__init__()
        self.tok, self.model, self.width, self.lead = tok, tok.model, width, lead
        self.bare = self if bare is None else bare
        self.mark = lead.replace(" ", BYTE_CHARS[32])
        self.packed = [i.to_bytes(width, "little") for i in range(tok.get_vocab_size())] if bare is None else bare.packed
        self.before: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        last = part[-1:]
        marked = last in MARKS and part[-2:-1].isalpha() and part[-2] <= LAST_LATIN
        if marked and len(part) > self.SHORT:
            return self[part[:-1]] + self.bare[last]
        if "\n" in part:
            lines = part.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return self[lines[0]] + b"".join([self.bare["\n"] + self.bare[x] for x in lines[1:]])
        ids = self.before.get(part)
        if ids is None:
            ids = self[part[:-1]] + self.bare[last] if marked else self.worked_out(part)
        if len(part) <= self.LONG:
            if len(self) >= self.LIMIT:
                self.before = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def worked_out(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            return b"".join([self.packed[t.id] for t in self.model.tokenize(self.mark + part)])
        word = WORD.fullmatch(part)
        if word:
            letters, marks = word.groups()
            if marks:
                return self[letters] + self.bare[marks]
            return b"".join([self.packed[t.id] for t in self.model.tokenize(self.mark + part.translate(LETTER_CHARS))])
        return np.array(self.tok.encode(self.lead + part, add_special_tokens=False).ids, f"<u{self.width}").tobytes()


def space_after_space(text: str) -> bool:
    """Whether white space comes before a space; most texts are told by faster means than a pattern."""
    if "  " in text or "\n " in text:
        return True
    raw = text.encode()
    return len(raw.translate(None, OTHER_SPACE)) < len(raw) and SPACE_AFTER_SPACE.search(text) is not None


def text_encoder(tokenizer_json: str, width: int):
    """A function from text to id bytes, for a byte-level tokenizer.

    Its pre-tokens never reach over a space that follows a non-space character,
    so texts are cut there.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_str(tokenizer_json)
    tok.encode_special_tokens = True  # parts hold no added tokens
    first = PartIds(tok, width)
    later = PartIds(tok, width, " ", first).__getitem__

    def encode(text: str) -> bytes:
        parts = WORD_END.split(text) if space_after_space(text) else text.split(" ")
        return first[parts[0]] + b"".join(map(later, parts[1:]))

    return with_added_tokens(tok, f"<u{width}", encode)


def held_encoder(tokenizer_json: str, width: int):
    """The encoder that this Python worker holds for its tasks."""
    key = ("parts", hashlib.sha256(tokenizer_json.encode()).hexdigest(), width)
    return worker_held(key, lambda: text_encoder(tokenizer_json, width))


def train_dictionary(docs: DataFrame, tokenizer_json: str, width: int) -> bytes:
    """A dictionary from the bounded sample; without training material, the sample's bytes as they are."""
    key = F.xxhash64("doc_id")
    least = docs.select(key.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if least is None:
        return b""

    def run(batches):
        encode = held_encoder(tokenizer_json, width)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encode(t.as_py())[:SAMPLE_IDS * width] for t in b.column(0)], pa.binary())], ["ids"])

    sample = docs.where(key <= least).orderBy(key, F.xxhash64("text")).limit(SAMPLE_DOCS).select("text")
    samples = [bytes(r["ids"]) for r in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too small samples to train on
        return b"".join(samples)[:DICTIONARY_BYTES]


def as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    width = 2 if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = train_dictionary(docs, tokenizer_json, width)
    sha = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(bytearray(raw), sha, width)], "dictionary binary, sha256 string, width int") \
        .write.parquet(f"{path}/dictionary")
    end = np.array([end_id], f"<u{width}").tobytes()

    def run(batches):
        encode = held_encoder(tokenizer_json, width)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(raw)).compress
        part, before = TaskContext.get().partitionId(), 0
        ids, counts, frames, size = [], [], [], 0

        def block():
            row = (part, before, ids[0], ids[-1], ids, counts, np.cumsum([0, *map(len, frames)]).tolist(), b"".join(frames), sha)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(row, BLOCK_FIELDS)], [n for n, _ in BLOCK_FIELDS])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                body = encode(text.as_py()) + end
                ids.append(doc)
                counts.append(len(body) // width)
                frames.append(press(body))
                size += len(frames[-1])
                if size >= BLOCK_BYTES:
                    yield block()
                    before += sum(counts)
                    ids, counts, frames, size = [], [], [], 0
        if ids:
            yield block()

    order = [F.col("doc_id"), F.xxhash64("text")]
    docs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(total).alias("n"))
    # one row per writer task
    parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_before")).write.parquet(f"{path}/parts")


def read_store(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and the ids (unsigned 32-bit), of all or some documents."""
    head = spark.read.parquet(f"{path}/dictionary").first()
    raw, sha, width = bytes(head["dictionary"]), head["sha256"], head["width"]
    blocks = spark.read.parquet(f"{path}/blocks")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        found = F.lit(False)
        for d in sorted(wanted):
            found = found | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
        blocks = blocks.where(found)
    blocks = blocks.join(spark.read.parquet(f"{path}/parts"), "part") \
        .select((F.col("ids_before") + F.col("part_before")).alias("before"), "doc_ids", "n_tokens", "offsets", "frames", "dictionary_sha256")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def run(batches):
        unpress = zstandard.ZstdDecompressor(dict_data=as_dictionary(raw)).decompress
        for b in batches:
            for before, docs, counts, offsets, frames, own in zip(*(c.to_pylist() for c in b.columns)):
                if own != sha:
                    raise ValueError(f"block written with dictionary {own}, the store's is {sha}")
                rows, start = [], before
                for doc, n, a, z in zip(docs, counts, offsets, offsets[1:]):
                    if wanted is None or doc in wanted:
                        body = np.frombuffer(unpress(frames[a:z]), f"<u{width}").astype("<u4").tobytes()
                        rows.append((doc, start, len(body) // 4, zlib.crc32(body), body)[:len(fields)])
                    start += n
                cols = zip(*rows) if rows else [[]] * len(fields)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
