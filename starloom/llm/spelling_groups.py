"""Spelling variant grouping (operator 11): sorted lists and banded edit rows.

Words within one edit of each other are found without comparing all words:

1. Words of one length class (the shorter one's length n; words of n and n + 1
   code points) meet under their first n // 2 code points or under their last
   n - n // 2, whichever the edit leaves alone. A key that more than GROUP words
   share is split again: the middle part that may still differ is halved in the
   same way, until it is one code point long, where a group is bounded by the
   alphabet. Every pair meets in exactly one group (the one that the place of
   its first difference names).
2. A group's middle parts are sorted and scanned: for each word, the words after
   it in the list, with an edit matrix of three diagonals whose rows are kept
   for as many code points as neighbours share (their LCP). Where a shared
   prefix is already more than one edit away, all words with it are skipped.
3. Groups give no pairs, only each word's number of near words and the best of
   them; these are added up per word.

Vocabulary counts are added up in tasks before they are shuffled. Forms are
followed to their roots by doubling jumps; as a form is FACTOR times as
frequent as its word, a chain has at most 27 links.

Defined results: a null or empty text has no words; rows with a null id count,
and write their id as an empty string in the hash. An empty table gives no
words. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settle

RUN = re.compile("[a-zÀ-ÿ]+")
DROP = 199  # one run in so many loses a code point
LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5
GROUP = 4000
HELD = 400_000  # words that a task holds before it hands on their counts
LAST = "\U0010ffff"

MEMBERS = "word string, n long, cls int, lo int, tail int, cap int, key string"


def words_of(doc: str, text: str, drop: int = DROP) -> list[tuple[str, int]]:
    """The distinct words of a text and their counts, hashed ones without one code point."""
    seen = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    head = zlib.crc32(f"{doc}:".encode())
    out = []
    for w, n in seen.items():
        h = zlib.crc32(w.encode(), head)
        if h % drop == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
        out.append((w, n))
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, drop: int = DROP) -> DataFrame:
    """word and n of the words that are long and frequent enough."""
    def run(batches):
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                for w, n in words_of("" if doc is None else str(doc), text.as_py() or "", drop):
                    if len(w) >= least_length:
                        held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    parts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def members(words: DataFrame) -> DataFrame:
    """Each word under its two keys in both length classes it belongs to."""
    size = F.length("word")
    both = words.withColumn("cls", F.explode(F.array(size, size - 1)))
    half = F.floor(F.col("cls") / 2).cast("int")
    front = F.struct(half.alias("lo"), F.lit(0).alias("tail"), F.lit(None).cast("int").alias("cap"))
    back = F.struct(F.lit(0).alias("lo"), (F.col("cls") - half).alias("tail"), half.alias("cap"))
    return keyed(both.withColumn("side", F.explode(F.array(front, back))).select("word", "n", "cls", "side.lo", "side.tail", "side.cap"))


def keyed(rows: DataFrame) -> DataFrame:
    """With the key that words meet under: the class, the parts' places and the parts."""
    fixed = F.concat(F.left(F.col("word"), F.col("lo")), F.lit(" "), F.when(F.col("tail") > 0, F.right(F.col("word"), F.col("tail"))).otherwise(""))
    return rows.withColumn("key", F.concat_ws(" ", "cls", "lo", "tail", F.coalesce(F.col("cap").cast("string"), F.lit("-")), fixed))


def halved(rows: DataFrame) -> DataFrame:
    """The rows of a large group, under the two halves of what may still differ."""
    half = F.floor((F.col("cls") - F.col("lo") - F.col("tail")) / 2).cast("int")
    front = F.struct((F.col("lo") + half).alias("lo"), F.col("tail").alias("tail"), F.col("cap").alias("cap"))
    back = F.struct(F.col("lo").alias("lo"), (F.col("cls") - F.col("lo") - half).alias("tail"), F.least("cap", F.col("lo") + half).alias("cap"))
    return keyed(rows.withColumn("side", F.explode(F.array(front, back))).select("word", "n", "cls", "side.lo", "side.tail", "side.cap"))


def shared(a: str, b: str) -> int:
    """How many first code points two strings share."""
    n, stop = 0, min(len(a), len(b))
    while n < stop and a[n] == b[n]:
        n += 1
    return n


def next_row(row: tuple[int, int, int], d: int, c: str, q: str) -> tuple[int, int, int]:
    """The edit matrix's row for d code points, the last being c, from the one before.

    A row holds the distances to q's first d - 1, d and d + 1 code points; 2 stands for all above 1.
    """
    left, mid, right = row
    m = len(q)
    low = same = high = 2
    if d - 1 <= m:
        low = min(mid + 1, left + (q[d - 2] != c) if d >= 2 else 2, 2)
    if d <= m:
        same = min(mid + (q[d - 1] != c), right + 1, low + 1, 2)
    if d + 1 <= m:
        high = min(right + (q[d] != c), same + 1, 2)
    return low, same, high


def near_in_list(parts: list[str]):
    """Places (i, j) in the sorted list of distinct strings that are exactly one edit apart.

    For each string, those after it are walked row by row. The rows of the string
    walked before are good as far as both agree. When a row holds no distance
    below 2, all strings with that prefix are skipped.
    """
    n = len(parts)
    lcp = [0] + [shared(a, b) for a, b in zip(parts, parts[1:])]
    for i in range(n - 1):
        q = parts[i]
        rows = [(2, 0, 1 if q else 2)]
        j, agree = i + 1, 0
        while j < n:
            s = parts[j]
            del rows[min(len(rows) - 1, agree) + 1:]
            row, dead = rows[-1], False
            for d in range(len(rows), len(s) + 1):
                row = next_row(row, d, s[d - 1], q)
                rows.append(row)
                if min(row) > 1:
                    dead = True
                    break
            if not dead:
                off = len(q) - len(s)
                if -1 <= off <= 1 and row[off + 1] == 1:
                    yield i, j
            j += 1
            if j < n:
                agree = lcp[j]
                if dead and agree >= len(rows) - 1:
                    j = bisect_left(parts, s[:len(rows) - 1] + LAST, j, n)
                    agree = shared(s, parts[j]) if j < n else 0


def near_counts(words: list[str], counts: list[int], cls: int, lo: int, tail: int, cap: int | None) -> list[tuple]:
    """(word, near words, best near word, its count) of a group's words that have near words in it."""
    order = sorted((w[lo:len(w) - tail], w, n) for w, n in zip(words, counts))
    found: dict[int, list] = {}
    for i, j in near_in_list([x[0] for x in order]):
        u, v = order[i][1], order[j][1]
        if len(u) > cls and len(v) > cls or cap is not None and u[:cap] == v[:cap]:
            continue  # of another class, or of the other half
        for a, b in ((i, j), (j, i)):
            rank = (-order[b][2], order[b][1])
            if a in found:
                found[a][0] += 1
                found[a][1] = min(found[a][1], rank)
            else:
                found[a] = [1, rank]
    return [(order[i][1], k, rank[1], -rank[0]) for i, (k, rank) in found.items()]


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """word, n_near, and the best near word and its count, of the words that have near words."""
    def run(batches):
        held, words, counts = None, [], []

        def out():
            rows = near_counts(words, counts, *held[1:]) if len(words) > 1 else []
            cols = list(zip(*rows)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                ["word", "k", "best", "best_n"])

        for b in batches:
            for w, n, cls, lo, tail, cap, key in zip(*(c.to_pylist() for c in b.columns)):
                if held is None or held[0] != key:
                    if len(words) > 1:
                        yield out()
                    held, words, counts = (key, cls, lo, tail, cap), [], []
                words.append(w)
                counts.append(n)
        if len(words) > 1:
            yield out()

    pending, found = settle(members(words)), None
    while True:
        large = settle(pending.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > group).select("key"))
        splits = F.col("cls") - F.col("lo") - F.col("tail") > 1
        done = large.isEmpty()
        ready = pending if done else pending.where(~splits).unionByName(pending.where(splits).join(large, "key", "left_anti"))
        ready = ready.select(*[c.split()[0] for c in MEMBERS.split(", ")])
        near = ready.repartition("key").sortWithinPartitions("key").mapInArrow(run, "word string, k long, best string, best_n long")
        found = near if found is None else found.unionByName(near)
        if done:
            break
        pending = settle(halved(pending.where(splits).join(large, "key", "left_semi")))
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("top")
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), best) \
        .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.rank")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """word and root of the words that have a form: (word, form) followed by doubling jumps."""
    jumps = settle(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = jumps.join(ahead, "root")
        if further.isEmpty():
            return jumps
        jumps = settle(jumps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, factor: int = FACTOR, drop: int = DROP, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n per word."""
    words = settle(count_words(docs, id_col, text_col, least_length, least_count, drop))
    near = near_words(words, group)
    own = words.join(near, "word", "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    own = settle(own.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                            F.when(is_form, F.col("best_n")).alias("form_n")))
    ends = roots(own.where(F.col("form").isNotNull()).select("word", "form"))
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
