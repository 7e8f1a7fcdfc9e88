"""Quality rules (operator 9): word counts, repetition and compression bands.

Each document is judged by itself in one pass without a shuffle. Base rules:
too few words, or too many words inside repeated 8-word windows. The method's
verdict: the zstandard ratio (raw bytes / compressed bytes) of the whole text
must lie inside a band that depends on its length, and so must the ratios of
the fixed chunks (the last may be shorter) that make up most of it. Repetitive text lies above the band, noise below it.

Defined results: a null text counts as a text without words (all counts 0,
base_failed, not kept); an empty text likewise. Other columns are ignored by
:func:`score` and carried through unchanged by :func:`keep_good`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
WINDOW = 8
REPEAT_PCT = 30
LEVEL = 3
CHUNK = 4096
# From this many UTF-8 bytes on: lowest ratio, lowest ratio where most bytes
# are not ASCII, highest ratio of a whole text. The lowest ones lie between
# measured noise (base64 in lines and words of random letters, digits and signs:
# at most 1.25 to 512 bytes, 1.32 to 1 KB, 1.36 to 2 KB, 1.40 beyond; random
# ideographs: 1.34 to 2 KB, 1.39 beyond) and measured clean text (Latin script:
# at least 1.16 at 256 bytes, 1.32 at 512, 1.49 at 1 KB, 1.67 at 2 KB, 1.84 at
# 4 KB; Chinese: 1.08 at 512 bytes, 1.25 at 1 KB, 1.46 at 2 KB, 1.66 at 4 KB).
# Where the two overlap, as in short texts, the limit keeps the clean text.
BANDS = ((0, 0.0, 0.0, 3.0), (128, 0.9, 0.9, 3.0), (256, 1.1, 0.9, 3.0), (512, 1.27, 1.0, 3.5), (768, 1.36, 1.1, 3.5),
         (1024, 1.42, 1.2, 4.0), (2048, 1.5, 1.38, 4.0), (4096, 1.5, 1.45, 5.0), (16384, 1.5, 1.45, 6.0))
# Chunks of CHUNK bytes and the rest: lowest ratio as above, highest ratio, and
# the share of the text's bytes in chunks outside that rejects.
CHUNK_HIGH = 5.0
CHUNK_SHARE = 0.25
ASCII = bytes(range(128))

SYMBOLS = re.compile(r"[#*$%&|<>]")
SCORE_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                "n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


def repeated_words(words: list, width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that the text holds at least twice."""
    n = len(words)
    if n <= width:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    span = 1
    while span < width:  # names of spans from names of two halves that overlap if need be
        step = min(span, width - span)
        pairs = ids[:len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        names, ids = np.unique(pairs, return_inverse=True)
        span += step
    twice = np.bincount(ids, minlength=len(names))[ids] > 1
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def limits(raw: bytes) -> tuple[float, float]:
    """Lowest and highest ratio of a text."""
    _, low, low_wide, high = [b for b in BANDS if len(raw) >= b[0]][-1]
    wide = not raw.isascii() and 2 * len(raw.translate(None, ASCII)) > len(raw)
    return low_wide if wide else low, high


def compression_verdict(raw: bytes, press) -> tuple[bool, float, int, int]:
    """(inside the bands, whole ratio, chunks, chunks outside their band)."""
    if not raw:
        return False, 0.0, 0, 0
    ratio = len(raw) / len(press(raw))
    low, high = limits(raw)
    chunks = [raw[at:at + CHUNK] for at in range(0, len(raw), CHUNK)]
    bad = [len(c) for c in chunks if not limits(c)[0] <= len(c) / len(press(c)) <= CHUNK_HIGH] if len(chunks) > 1 else []
    return low <= ratio <= high and sum(bad) <= CHUNK_SHARE * len(raw), ratio, len(chunks), len(bad)


def measure(text: str | None, press) -> tuple:
    """The columns of SCORE_SCHEMA after doc_id."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(SYMBOLS.findall(text or ""))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_PCT * n
    inside, ratio, chunks, bad = compression_verdict(raw, press)
    return (n, chars, symbols, len(lines) - len(set(lines)), repeats, failed, not failed and inside, ratio, chunks, bad)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measures and verdicts per document."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            rows = [measure(t.as_py(), press) for t in b.column(1)]
            cols = list(zip(*rows)) if rows else [[] for _ in range(10)]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64())] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                [x.split()[0] for x in SCORE_SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCORE_SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            yield b.filter(pa.array([measure(t.as_py(), press)[6] for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
