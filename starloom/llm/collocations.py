"""Phrase collocation mining (operator 12): weighted acyclic automata.

Every place of a text starts a window of up to ORDER words of its piece. A
window passes through an arc for each of its words, so the weight of a path from
the start, the number of windows passing, is the count of that phrase.

1. A task gathers windows of its shard (at most HELD words), sorts them and
   builds an acyclic weighted automaton from the sorted windows, arc by arc: a
   window opens new arcs from the place where it leaves the one before
   (``Automaton``, flat arrays of arc labels, arc weights and ends). It hands on
   the part of every prefix range of the order of windows as a row, compressed.
2. A task unites all automata of a prefix range by summing weights and names the
   phrases that are frequent enough. Range edges may cut a path in two, so paths
   at an edge are handed on whatever their weight and summed once more.
3. Cuts of candidates ask for the counts of their parts: the automaton of a
   prefix range's frequent phrases is composed with the sorted parts that fall
   into that range. A range that many cuts ask for (a frequent word) is asked in
   blocks of ASKED cuts, each with a copy of that automaton.
4. Scores, the drop rule and the ranks are DataFrame operations.

Prefix ranges come from at most about SAMPLE windows; they only divide the work.
A hot word, pair or language is collapsed in its shard and divided over ranges.

Defined results: a null text is empty, a null language is ``und``. Repeated rows
count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import settle

ORDER = 3
LEAST = 10
COVERED_PCT = 50
TOP = 2000
UNIT = 1_000_000
SAMPLE = 100_000
SAMPLE_DOCS, SAMPLE_EACH = 2_000, 50
HELD = 2_000_000
RANGE_WINDOWS = 2_000_000
ASKED = 200_000
BITS = 21  # a window's words as ranks in one 64-bit number
PRESS_LEVEL = 1

PIECE_END = re.compile("[.,;:!?\\n-\\r]+")


class Ids(dict):
    """Numbers for words, from 1 on; a piece's end is 0 and no word -1."""

    def __init__(self):
        super().__init__({"\n": 0, "": -1})

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self) - 1
        return n


def words_and_ends(text: str) -> list[str]:
    """The words of a text, with a line feed where a piece ends."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return PIECE_END.sub(" \n ", low).replace("\t", " ").split(" ")


def pressed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on as bytes, few for small ones: compressed, all lowest bytes first, then all second ones and so on."""
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T
    used = max((k + 1 for k in range(8) if planes[k].any()), default=1)
    return bytes([used]) + zstandard.ZstdCompressor(PRESS_LEVEL).compress(planes[:used].tobytes())


def unpressed(raw: bytes) -> np.ndarray:
    raw = memoryview(raw)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    numbers = np.zeros((planes.shape[1], 8), np.uint8)
    numbers[:, :raw[0]] = planes.T
    return numbers.view("<i8").ravel()


def firsts(numbers: np.ndarray) -> np.ndarray:
    """Where in sorted numbers another one begins."""
    new = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=new[1:])
    return np.flatnonzero(new)


def renumbered(keys: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The windows with other numbers for their words."""
    out = np.zeros(len(keys), np.int64)
    for k in range(ORDER):
        out <<= BITS
        out |= to[(keys >> BITS * (ORDER - 1 - k)) & ((1 << BITS) - 1)]
    return out


def windows_of(ids: np.ndarray, starts: int | None = None) -> list[np.ndarray]:
    """Of every word (of the first ``starts``), itself and the words after it in its piece (0 where there is none)."""
    none = np.zeros(1, ids.dtype)
    first = np.append(ids, none)
    out = [first]
    for _ in range(ORDER - 1):
        after = np.append(out[-1][1:], none)
        # once a window has ended it stays so
        out.append(np.where(out[-1] == 0, 0, after))
    keep = first != 0
    if starts is not None:
        keep[starts:] = False
    return [x[keep] for x in out]


class Automaton:
    """A weighted acyclic automaton over words, built from sorted windows.

    ``vocabulary`` is sorted; ``keys`` are the sorted distinct windows (each
    word's place in the vocabulary plus 1, BITS bits a word) and ``weights``
    their counts. ``arcs(depth)`` gives the arcs of that depth: where a window
    leaves the path of the one before, an arc opens.
    """

    def __init__(self, vocabulary: list[str], keys: np.ndarray, weights: np.ndarray):
        self.vocabulary, self.keys, self.weights = vocabulary, keys, weights

    @classmethod
    def from_windows(cls, columns: list[np.ndarray], words: list[str]) -> Automaton:
        """Of a shard's windows as word numbers (0 after the end); ``words[n - 1]`` is the word of number n. Takes the columns out of the list."""
        if len(words) >= 1 << BITS:
            raise OverflowError("more words in a shard than its keys can number")
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.zeros(len(words) + 1, np.int64)
        rank[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
        key = rank[columns.pop(0)]
        while columns:
            key <<= BITS
            key |= rank[columns.pop(0)]
        key.sort()
        at = firsts(key)
        return cls([words[i] for i in order], key[at], np.diff(at, append=len(key)))

    def between(self, low: tuple | None, high: tuple | None) -> Automaton | None:
        """The part whose windows lie in [low, high), with its own vocabulary."""
        a = 0 if low is None else int(np.searchsorted(self.keys, self.place(low)))
        z = len(self.keys) if high is None else int(np.searchsorted(self.keys, self.place(high)))
        return self.part(a, z) if z > a else None

    def place(self, words: tuple) -> int:
        """The least key that is not before the words."""
        key = 0
        for k in range(ORDER):
            w = words[k] if k < len(words) else None
            if w is None:
                return key << BITS * (ORDER - k)
            at = bisect_left(self.vocabulary, w)
            if at == len(self.vocabulary) or self.vocabulary[at] != w:
                return (key << BITS | at + 1) << BITS * (ORDER - 1 - k)
            key = key << BITS | at + 1
        return key

    def part(self, a: int, z: int) -> Automaton:
        keys = self.keys[a:z]
        columns = [(keys >> BITS * (ORDER - 1 - k)) & ((1 << BITS) - 1) for k in range(ORDER)]
        used = np.unique(np.concatenate(columns))
        new = np.searchsorted(used, columns[0]) + (used[0] != 0)
        for c in columns[1:]:
            new = (new << BITS) | (np.searchsorted(used, c) + (used[0] != 0))
        return Automaton([self.vocabulary[i - 1] for i in used.tolist() if i], new, self.weights[a:z])

    def to_row(self) -> tuple:
        """Words, arc labels by depth with the number of arcs that follow each, and the windows' weights, pressed."""
        parts = []
        for depth in range(1, ORDER + 1):
            at, label = self.arcs(depth)
            up = np.searchsorted(at, self.arcs(depth - 1)[0]) if depth > 1 else np.zeros(1, np.int64)
            parts += [pressed(label), pressed(np.diff(np.append(up, len(at))))]
        words = "\n".join(self.vocabulary).encode("utf-8", "surrogatepass")
        return (zstandard.ZstdCompressor(PRESS_LEVEL).compress(words), *parts, pressed(self.weights))

    @classmethod
    def from_row(cls, row: tuple) -> Automaton:
        words, *parts, weights = row
        keys = np.zeros(1, np.int64)
        for k in range(ORDER):
            label, fan = unpressed(parts[2 * k]), unpressed(parts[2 * k + 1])
            keys = (np.repeat(keys, fan) << BITS) | label
        vocabulary = zstandard.ZstdDecompressor().decompress(words).decode("utf-8", "surrogatepass")
        return cls(vocabulary.split("\n"), keys, unpressed(weights))

    def arcs(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows that open an arc of this depth, and the arcs' labels."""
        prefix = self.keys >> BITS * (ORDER - depth)
        at = firsts(prefix)
        return at, prefix[at] & ((1 << BITS) - 1)

    @classmethod
    def union(cls, many: Iterable[Automaton]) -> Automaton:
        """One automaton with the sums of the weights. Takes one after another and keeps none, only their keys and weights."""
        number: dict[str, int] = {}  # as the words come, until all are known
        keys, weights = [], []
        for x in many:
            to = np.array([0, *[number.setdefault(w, len(number) + 1) for w in x.vocabulary]], np.int64)
            if len(number) >= 1 << BITS:
                raise OverflowError("more words in a prefix range than its keys can number")
            keys.append(renumbered(x.keys, to))
            weights.append(x.weights.astype(np.min_scalar_type(x.weights.max())))
        vocabulary = sorted(number)
        rank = np.zeros(len(number) + 1, np.int64)
        rank[[number[w] for w in vocabulary]] = np.arange(1, len(number) + 1)
        del number
        for k, key in enumerate(keys):
            keys[k] = renumbered(key, rank)
        every = np.concatenate(keys)
        keys.clear()
        # of runs in order
        order = np.argsort(every, kind="stable")
        every = every[order]
        each = np.concatenate(weights)[order]
        del order
        at = firsts(every)
        return cls(vocabulary, every[at], np.add.reduceat(each, at, dtype=np.int64))

    def phrases(self, least: int, edges: bool) -> list[tuple[tuple[str, ...], int]]:
        """Paths with at least this weight; with ``edges`` also those of the first and the last window."""
        out = []
        for depth in range(1, ORDER + 1):
            at, label = self.arcs(depth)
            weight = np.add.reduceat(self.weights, at)
            good = (weight >= least) & (label != 0)
            if edges and len(at):
                good[[0, -1]] = label[[0, -1]] != 0
            for i in np.flatnonzero(good).tolist():
                key = int(self.keys[at[i]])
                words = tuple(self.vocabulary[(key >> BITS * (ORDER - 1 - k) & (1 << BITS) - 1) - 1] for k in range(depth))
                out.append((words, int(weight[i])))
        return out


def compose(weighted: list[tuple[tuple, int]], asked: list[tuple]) -> list[int | None]:
    """The weights of sorted asked paths in the automaton of sorted weighted paths: both are walked once, side by side."""
    out, i = [], 0
    for path in asked:
        while i < len(weighted) and weighted[i][0] < path:
            i += 1
        out.append(weighted[i][1] if i < len(weighted) and weighted[i][0] == path else None)
    return out


BLOB = ", ".join(["at int", "lang string", "windows long", "words binary"]
                 + [f"{x}{k} binary" for k in range(1, ORDER + 1) for x in ("label", "fan")] + ["weights binary"])


def prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def range_edges(docs: DataFrame, ranges: int) -> list[tuple]:
    """Starts (lang, words...) of all prefix ranges but the first, from a bounded sample of windows."""
    if ranges < 2:
        return []
    rows = docs.count()

    def run(batches):
        for b in batches:
            found = []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                w = [x for x in words_and_ends(text.as_py()) if x]
                step = max(1, len(w) // SAMPLE_EACH)
                for i in range(0, len(w), step)[:SAMPLE_EACH]:
                    if w[i] != "\n":
                        k = w[i:i + ORDER]
                        found.append([lang, *(k[:k.index("\n")] if "\n" in k else k)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["path"])

    some = docs.sample(fraction=min(1.0, SAMPLE_DOCS / max(rows, 1)), seed=17).mapInArrow(run, "path array<string>").limit(SAMPLE)
    paths = sorted(tuple(r["path"]) for r in some.collect())
    return sorted({paths[len(paths) * k // ranges] for k in range(1, ranges)}) if paths else []


def shard_automata(docs: DataFrame, edges: list[tuple]) -> DataFrame:
    """Automata of bounded shards, a row for each prefix range they reach."""
    names = [x.split()[0] for x in BLOB.split(", ")]
    kinds = [pa.int32(), pa.string(), pa.int64()] + [pa.binary()] * (2 * ORDER + 2)

    def rows_of(lang, ids, columns):
        built = Automaton.from_windows(columns, [w for w in ids if w not in ("", "\n")])
        first, last = bisect_right(edges, (lang,)), bisect_left(edges, (lang + "\0",))
        for at in range(first, last + 1):
            low = edges[at - 1][1:] if at > first else None
            high = edges[at][1:] if at < last else None
            part = built.between(low, high)
            if part is not None:
                yield (at, lang, int(part.weights.sum()), *part.to_row())

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches):
        held: dict[str, list] = {}  # by language: numbers of words, and lists of them

        def out():
            while held:
                lang = next(iter(held))
                ids, parts, _ = held.pop(lang)
                every = np.concatenate(parts)
                parts.clear()
                every = every[every >= 0]
                yield batch(list(rows_of(lang, ids, windows_of(every))))

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_and_ends(text.as_py())
                if len(words) > HELD:  # shards of its own, each with the words that its last windows need
                    words = [w for w in words if w]
                    for a in range(0, len(words), HELD):
                        ids, some = Ids(), words[a:a + HELD + ORDER - 1]
                        numbers = np.fromiter(map(ids.__getitem__, some), np.int32, len(some))
                        yield batch(list(rows_of(lang, ids, windows_of(numbers, HELD))))
                    continue
                own = held.setdefault(lang, [Ids(), [], 0])
                own[1].append(np.fromiter(map(own[0].__getitem__, words), np.int32, len(words)))
                own[1].append(np.zeros(1, np.int32))
                own[2] += len(words)
                if sum(x[2] for x in held.values()) >= HELD:
                    yield from out()
        yield from out()

    return docs.mapInArrow(run, BLOB)


def count_phrases(blobs: DataFrame, least: int) -> DataFrame:
    """lang, words, f of the frequent phrases."""
    def unite(key, table):
        langs = table.column("lang").to_pylist()
        pressed_columns = table.columns[3:]
        out = []
        for lang in sorted(set(langs)):
            rows = (tuple(c[i].as_buffer() for c in pressed_columns) for i, x in enumerate(langs) if x == lang)
            whole = Automaton.union(map(Automaton.from_row, rows))
            out += [(lang, list(words), f) for words, f in whole.phrases(least, True)]
        cols = list(zip(*out)) if out else [[]] * 3
        return pa.table({"lang": pa.array(cols[0], pa.string()), "words": pa.array(cols[1], pa.list_(pa.string())), "f": pa.array(cols[2], pa.int64())})

    parts = blobs.groupBy("at").applyInArrow(unite, "lang string, words array<string>, f long")
    return parts.groupBy("lang", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def with_counts(cuts: DataFrame, phrases: DataFrame, edges: list[tuple], part: str, name: str) -> DataFrame:
    """Adds the count of the phrase in column ``part`` as ``name``."""
    @F.udf("int")
    def range_of(lang, words):
        return bisect_right(edges, (lang, *words))

    placed = settle(cuts.withColumn("at", range_of("lang", part)))
    copies = placed.groupBy("at").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("copies"))
    known = phrases.withColumn("at", range_of("lang", "words")).join(copies, "at") \
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))) \
        .select(F.col("at").alias("place"), F.col("copy").alias("block"), F.col("lang").alias("of"), F.col("words").alias("path"), F.col("f").alias("weight"))
    asked = placed.join(copies, "at").withColumn("copy", F.pmod(F.xxhash64("words", "k"), F.col("copies")).cast("int")).drop("copies")
    names = [c for c in asked.columns if c not in ("at", "copy")]
    at_lang, at_part = asked.columns.index("lang"), asked.columns.index(part)

    def run(key, own, there):
        paths = [(x, *w) for x, w in zip(own.column(at_lang).to_pylist(), own.column(at_part).to_pylist())]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        weighted = sorted(((x, *w), f) for x, w, f in zip(*(there.column(c).to_pylist() for c in ("of", "path", "weight"))))
        found = [0] * len(paths)
        for i, f in zip(order, compose(weighted, [paths[i] for i in order])):
            found[i] = f
        return own.select(names).append_column(name, pa.array(found, pa.int64()))

    schema = ", ".join(f"{n} {t}" for n, t in asked.select(*names).dtypes) + f", {name} long"
    return asked.groupBy("at", "copy").cogroup(known.groupBy("place", "block")).applyInArrow(run, schema)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, covered_pct: int = COVERED_PCT,
                 top: int = TOP, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    docs = prepared(docs, text_col, lang_col)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    edges = range_edges(docs, int(chars // 6 // range_windows) + 1)
    blobs = settle(shard_automata(docs, edges))
    totals = blobs.groupBy("lang").agg(F.sum("windows").alias("n"))
    phrases = settle(count_phrases(blobs, least))
    candidates = phrases.where(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))) \
        .withColumn("head", F.slice("words", F.lit(1), F.col("k"))) \
        .withColumn("rest", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    counted = with_counts(with_counts(cuts, phrases, edges, "head", "l"), phrases, edges, "rest", "r")

    @F.udf("long")
    def score(a, l, r):  # noqa: E741  whole numbers of any size
        return UNIT * a * a // (l * r)

    lowest = F.min(F.struct(score("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut")
    scored = counted.groupBy("lang", "words").agg(F.first("a").alias("a"), lowest)
    inner = F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1))
    longer = candidates.where(F.size("words") > 2).select("lang", F.explode(inner).alias("words"), "a") \
        .groupBy("lang", "words").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "words"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered_pct * F.col("a")))
    named = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    # only the best rows of each task go on
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))) \
        .where(F.col("rank") <= top)
    return ranked.join(totals, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
