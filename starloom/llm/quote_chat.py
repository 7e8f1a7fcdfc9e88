"""Chat formatting (operator 3): quotation linking.

A message's lines are parsed into nested quote levels (``>``, ``> >``, ``>>``);
consecutive lines of one level form a passage, and blank lines end it. Passages
are normalised (lower case, white space collapsed to one space) and hashed. A
quoted passage links its message to the latest earlier message of the same
conversation that holds the passage as a passage or a line of its own text;
failing that, a quoted passage of several lines (a part of a longer passage,
say) links to the latest earlier message whose own lines hold all of its lines
in their order; lines broken elsewhere are other lines. A message replies to the
earliest message that its least nested linked quotes name. Threads are the
trees that these links span; the conversation is put in reply order by sorting
messages by (thread, turn), where thread is the first message of the tree;
messages without a link start a thread of their own, so a conversation without
quotes keeps its order. ``content`` is the message without quotes.

Defined results: one row per input row, with its role kept. A null or empty
text has no passages and an empty content. Rows with a null conv_id or turn are
linked with nothing; their thread is their own turn. Several rows of one turn
are linked alike: what one of them quotes counts for the turn, and each row's
counts are its own.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settle

MARKS = re.compile(r"[ \t]*((?:>[ \t]*)+)")
PARSED = ("row long, conv_id long, turn long, role string, content string, "
          "passages array<struct<level: int, hash: string, lines: array<string>>>")
PASSAGES = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.string()), ("lines", pa.list_(pa.string()))]))


def quote_level(line: str) -> tuple[int, str]:
    """Nesting of a line, and the line without its marks."""
    m = MARKS.match(line)
    return (m[1].count(">"), line[m.end():]) if m else (0, line)


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


def hashed(passage: str) -> str:
    return hashlib.sha256(passage.encode("utf-8", "surrogatepass")).hexdigest()


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """The content without quotes; (level, normalised lines) of each passage."""
    own, runs = [], []
    last, gap = None, True
    for line in text.splitlines():
        level, body = quote_level(line)
        if level == 0:
            own.append(line)
        body = normalised(body)
        if not body:
            gap = True
        elif gap or level != last:
            runs.append((level, [body]))
            last, gap = level, False
        else:
            runs[-1][1].append(body)
    return "\n".join(own).strip(), runs


def latest_with_lines(passages: DataFrame, own: DataFrame, originals: DataFrame) -> DataFrame:
    """``passages`` (conv_id, turn, hash, lines) with the latest earlier turn whose own lines hold all of theirs in order.

    Only messages that have the passage's rarest line are looked at.
    """
    written = originals.groupBy("conv_id", F.col("hash").alias("line")).agg(F.count("*").alias("n"))
    rarest = passages.withColumn("line", F.explode(F.array_distinct("lines"))).join(written, ["conv_id", "line"], "left") \
        .groupBy("conv_id", "turn", "hash", "lines").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "line")).alias("least")) \
        .where("least.n > 0").select("conv_id", "turn", "hash", "lines", "least.line")
    posts = originals.select("conv_id", F.col("hash").alias("line"), F.col("turn").alias("source"))
    held = F.aggregate("own", F.lit(0), lambda i, x: F.when(F.get("lines", i) == x, i + 1).otherwise(i))
    return rarest.join(posts, ["conv_id", "line"]).where("source < turn") \
        .join(own.withColumnRenamed("turn", "source"), ["conv_id", "source"]).where(held == F.size("lines")) \
        .groupBy("conv_id", "turn", "hash", "lines").agg(F.max("source").alias("source"))


def link_quotes(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, n_quotes, n_linked, reply_to, thread, content per message."""

    def run(batches):
        for b in batches:
            parsed = [parse(t.as_py() or "") for t in b.column(4)]
            passages = [[{"level": level, "hash": hashed(" ".join(lines)), "lines": [hashed(x) for x in lines]}
                         for level, lines in found] for _, found in parsed]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([c for c, _ in parsed], pa.string()), pa.array(passages, PASSAGES)],
                                             ["row", "conv_id", "turn", "role", "content", "passages"])

    rows = messages.select(F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").alias("conv_id"),
                           F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col(text_col).alias("text"))
    kept = settle(rows.mapInArrow(run, PARSED))
    keyed = kept.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    parts = keyed.select("row", "conv_id", "turn", F.explode("passages").alias("p")) \
        .select("row", "conv_id", "turn", "p.level", "p.hash", "p.lines")
    quotes = parts.where("level > 0")
    originals = parts.where("level = 0").select("conv_id", F.explode(F.array_union(F.array("hash"), "lines")).alias("hash"), "turn").distinct()
    asked = quotes.select("conv_id", "hash", "turn").distinct()
    # the latest own turn before the quoting turn
    whole = settle(asked.join(originals.withColumnRenamed("turn", "source"), ["conv_id", "hash"]).where("source < turn")
                   .groupBy("conv_id", "hash", "turn").agg(F.max("source").alias("source")))
    trimmed = quotes.where(F.size("lines") > 1).select("conv_id", "turn", "hash", "lines").distinct() \
        .join(whole, ["conv_id", "hash", "turn"], "left_anti")
    own = keyed.select("conv_id", "turn", F.flatten(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["lines"])).alias("own")) \
        .where(F.size("own") > 1)
    partly = latest_with_lines(trimmed, own, originals).withColumnRenamed("source", "part_source")
    linked = quotes.join(whole, ["conv_id", "hash", "turn"], "left").join(partly, ["conv_id", "turn", "hash", "lines"], "left") \
        .withColumn("source", F.coalesce("source", "part_source"))
    counts = linked.groupBy("row").agg(F.count("*").alias("n_quotes"), F.count("source").alias("n_linked"))
    replies = settle(linked.where("source IS NOT NULL").groupBy("conv_id", "turn")
                     .agg(F.min(F.struct("level", "source"))["source"].alias("reply_to")))
    threads = roots(replies)
    out = kept.drop("passages").join(counts, "row", "left").join(replies, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                      "reply_to", F.coalesce("thread", "turn").alias("thread"), "content")


def roots(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread: the first message of each reply's tree, by doubling jumps."""
    at = replies.select("conv_id", "turn", F.col("reply_to").alias("thread"))
    while True:
        up = at.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        joined = settle(at.join(up, ["conv_id", "thread"], "left"))
        at = joined.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"))
        if joined.where("above IS NOT NULL").isEmpty():
            return at


def format_chat(linked: DataFrame, start: str = "<|", close: str = "|>\n", end: str = "\n") -> DataFrame:
    """Each message of :func:`link_quotes` as chat text, with the keys to read a conversation in reply order."""
    role = F.coalesce("role", F.lit("user"))
    return linked.withColumn("chat", F.concat(F.lit(start), role, F.lit(close), F.col("content"), F.lit(end)))


def conversations(formatted: DataFrame) -> DataFrame:
    """conv_id and its chat text in reply order; a conversation must fit in a row, as a document does."""
    parts = F.array_sort(F.collect_list(F.struct("thread", "turn", "chat")))
    return formatted.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["chat"]), "").alias("chat"))
