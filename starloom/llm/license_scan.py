"""License scans (operator 6), by DataFrame functions only.

Texts and templates are normalised alike: lower case, runs of anything but
letters a-z and digits become one space. Comment signs, line breaks and
paragraphs thus do not matter. They are compared by the Dice coefficient over
their sets of word bigrams, 2 * common / (own + template's). A text's units for a
template are the windows that start at one of the template's bigrams and have as
many bigrams as it, a quarter more, or the most that it allows; the text's end
cuts them. So a notice is found inside a longer line, over several paragraphs and
in a text of any length.

A coefficient of at least ``t`` needs ``t/(2-t) * template <= own <= (2-t)/t *
template``, and as common bigrams are own ones, at least the lower bound of common
ones. Hence a template is tried only on a text that holds so many of its bigrams,
and only where so many of them start within the longest window; both lose
nothing. Of the windows nearest to each template, one that overlaps a likelier
one of another template does not count (a notice is near those of related
licences too). Everything but the last grouping is work inside a row.

Defined results: one row per distinct doc_id (null ids form one row; rows of one
id are judged singly and united); a null or empty text has no licence: n_licenses
0, licenses empty, license and dice null. Ties go to the template listed first,
then to the first window, then to the shortest.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.license_texts import TEMPLATES

THRESHOLD_PCT = 80


def bigram_list(text: str) -> list[str]:
    """A template's word bigrams in order, normalised."""
    words = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def size_bounds(n: int, pct: int = THRESHOLD_PCT) -> tuple[int, int]:
    """Fewest and most bigrams that a unit near enough to a template of n bigrams can have."""
    return -(-pct * n // (200 - pct)), (200 - pct) * n // pct


def window_sizes(n: int, distinct: int, pct: int = THRESHOLD_PCT) -> list[int]:
    """Bigrams of the windows tried for a template of n bigrams."""
    return sorted({n, n * 5 // 4, max(n, size_bounds(distinct, pct)[1])})


def template_table(templates=TEMPLATES, pct: int = THRESHOLD_PCT) -> list[dict]:
    found = []
    for rank, (name, text) in enumerate(templates):
        every = bigram_list(text)
        grams = list(dict.fromkeys(every))
        low, high = size_bounds(len(grams), pct)
        found.append({"rank": rank, "license": name, "grams": grams, "low": low, "high": high,
                      "sizes": window_sizes(len(every), len(grams), pct)})
    return found


TABLE = "array<struct<rank:int,license:string,grams:array<string>,low:int,high:int,sizes:array<int>>>"


def bigrams(text: Column) -> Column:
    # A-Z only: lower() may turn other letters into these
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ")
    # the last word has no partner: its pair is null and goes
    return F.slice(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b)),
                   1, F.greatest(F.size(words) - 1, F.lit(0)))


def scan(docs: DataFrame, templates=TEMPLATES, pct: int = THRESHOLD_PCT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_licenses, licenses (names found, sorted, comma-joined), license and dice of the likest template."""
    known = template_table(templates, pct)
    table = F.from_json(F.lit(json.dumps(known)), TABLE)
    every = F.from_json(F.lit(json.dumps(sorted({g for t in known for g in t["grams"]}))), "array<string>")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), bigrams(F.coalesce(F.col(text_col), F.lit(""))).alias("pairs"))
    held = texts.withColumn("held", F.array_intersect("pairs", every))
    # of the text's bigrams only those of some template are looked through per template
    tried = F.when(F.size("held") >= min(t["low"] for t in known),
                   F.filter(table, lambda t: F.size(F.array_intersect("held", t["grams"])) >= t["low"]))
    rows = held.select("doc_id", "row", F.when(F.size("held") > 0, F.col("pairs")).alias("pairs"), F.explode_outer(tried).alias("t"))
    t, pairs = F.col("t"), F.col("pairs")
    rows = rows.withColumn("starts", F.when(t.isNotNull(), F.filter(
        F.sequence(F.lit(1), F.size(pairs)), lambda p: F.array_contains(t["grams"], F.get(pairs, p - 1)))))
    starts = F.col("starts")
    # the low-th hit from here on has to start inside the longest window (low is 1 at least)
    dense = F.filter(starts, lambda p, i: F.get(starts, i + t["low"] - 1) - p < F.array_max(t["sizes"]))

    def like(p: Column, n: Column) -> Column:
        unit = F.slice(pairs, p, n)
        own, common = F.size(F.array_distinct(unit)), F.size(F.array_intersect(unit, t["grams"]))
        both = own + F.size(t["grams"])
        near = own.between(t["low"], t["high"]) & (200 * common >= pct * both)
        return F.when(near, F.struct((F.lit(2.0) * common / both).alias("dice"), (-p).alias("back"), (-n).alias("short")))

    best = F.array_max(F.transform(dense, lambda p: F.array_max(F.transform(t["sizes"], lambda n: like(p, n)))))
    found = rows.select("doc_id", "row", t["license"].alias("name"), t["rank"].alias("rank"), best.alias("b"))
    hit = F.when(F.col("b").isNotNull(), F.struct(
        F.col("b.dice").alias("dice"), (-F.col("rank")).alias("order"), "name", "row", (-F.col("b.back")).alias("start"),
        (-F.col("b.back") - F.col("b.short")).alias("stop")))
    # one hit per template and row at most; of overlapping windows the likest counts
    clear = F.filter("hits", lambda h: ~F.exists("hits", lambda o: (o["row"] == h["row"]) & (o["start"] < h["stop"]) & (h["start"] < o["stop"])
                                                 & (F.struct(o["dice"], o["order"]) > F.struct(h["dice"], h["order"]))))
    likest = F.array_max("hits")
    return found.groupBy("doc_id").agg(F.collect_list(hit).alias("hits")) \
        .withColumn("names", F.array_sort(F.array_distinct(F.transform(clear, lambda h: h["name"])))) \
        .select("doc_id", F.size("names").cast("long").alias("n_licenses"), F.array_join("names", ",").alias("licenses"),
                likest["name"].alias("license"), likest["dice"].alias("dice"))
