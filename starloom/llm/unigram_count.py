"""Token counts (operator 1): count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton names every vocabulary piece that ends at each
character; dynamic programming keeps, per position, the best score and the
number of pieces on the best way there, and no back pointers. Ties go to the
longer last piece (the one that starts first), as the tokenizer's forward
search with a strict comparison decides. A character without a one-character
piece may also be passed as unknown (lowest score less 10); it then counts as
its UTF-8 bytes (byte fallback).

White space: the text gets one leading space, spaces become U+2581. As no
piece holds U+2581 after another character, the best segmentation of a text is
that of its space-led segments one by one, so each distinct segment is solved
once per task. If some piece did, the whole text would be one segment. Scores
add up in double precision.

Defined results: null and empty texts have 0 tokens and score 0.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
SEGMENT = re.compile(SPACE + "+[^" + SPACE + "]*")


def load_vocabulary(model_path: str) -> dict[str, float]:
    """Pieces and scores of a vocabulary file, without control and byte pieces."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}


def make_solver(vocabulary: dict[str, float]):
    """A function from a segment to (pieces, score) of its best segmentation."""
    auto = ahocorasick.Automaton()
    for piece, score in vocabulary.items():
        auto.add_word(piece, (len(piece), score))
    auto.make_automaton()
    unknown = min(vocabulary.values()) - UNKNOWN_PENALTY

    def solve(segment: str) -> tuple[int, float]:
        n = len(segment)
        ends: list[list] = [[] for _ in range(n)]
        for end, hit in auto.iter(segment):
            ends[end].append(hit)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            best, pieces, single = None, 0, False
            for size, own in sorted(ends[end], reverse=True):  # longer first, so ties keep it
                total = score[end + 1 - size] + own
                single |= size == 1
                if best is None or total > best:
                    best, pieces = total, count[end + 1 - size] + 1
            if not single:
                total = score[end] + unknown
                if best is None or total > best:
                    best, pieces = total, count[end] + len(segment[end].encode("utf-8", "surrogatepass"))
            score[end + 1], count[end + 1] = best, pieces
        return count[n], score[n]

    return solve


def segments(text: str, separable: bool) -> list[str]:
    """Segments without their first U+2581."""
    text = text.replace(" ", SPACE)
    if not separable:
        return [text]
    if SPACE * 2 not in text and not text.startswith(SPACE):
        return text.split(SPACE)
    return [s[1:] for s in SEGMENT.findall(SPACE + text)]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, score per document."""
    vocabulary = load_vocabulary(model_path)
    separable = not any(SPACE in p.lstrip(SPACE) for p in vocabulary)

    def run(batches):
        solve = make_solver(vocabulary)
        memo = Memo(lambda keys: [solve(SPACE + k) for k in keys])
        for b in batches:
            counts, scores = [], []
            for t in b.column(1):
                text = t.as_py()
                if not text:
                    counts.append(0)
                    scores.append(0.0)
                    continue
                found = list(memo.look(segments(text, separable)))
                counts.append(sum(x[0] for x in found))
                scores.append(sum(x[1] for x in found))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                ["doc_id", "n_tokens", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, score double")
