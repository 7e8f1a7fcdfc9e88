"""Token counts, byte-level BPE, quality rules, licence scans and quotation linking against plain versions."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from tokenizers import Tokenizer, models

from starloom.llm import bpe_chunks, license_scan, quality_bands, quote_chat, unigram_count

DOCS = "doc_id long, text string, ids string, n_words int, row string, score string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, None, "y") for i, t in zip(ids, texts)], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "stone", "river", "éclair", "über", "it's", "we'll", "12", "3.5", "日本語", "don't", "x", "\n", "(ok)", "a,b"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing", "!"]) for _ in range(n))


TEXTS = [None, "", " ", "a", "Hello  world\n x ", "  lead", "tab\t\tx \n\n\n  y", "naïve café \x1c x\x85y　z", "'ll 're 'x''s", "\n" * 40,
         "w" * 300, prose(1, 50), prose(1, 50), prose(2, 900), "𝔘𝔫𝔦 👩‍👩‍👧 <|endoftext|>"]


def test_token_counts_match_a_unigram_tokenizer(spark):
    vocabulary = unigram_count.load_vocabulary(PIECES)
    entries = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + list(vocabulary.items())
    tok = Tokenizer(models.Unigram(entries, 0, True))
    got = {r.doc_id: r.n_tokens for r in unigram_count.count_tokens(table(spark, TEXTS), PIECES).collect()}
    want = {i: len(tok.encode(("▁" + t.replace(" ", "▁")) if t else "").ids) for i, t in enumerate(TEXTS)}
    assert got == want


def test_token_counts_ties_take_the_longer_last_piece():
    solve = unigram_count.make_solver({"a": -1.0, "b": -1.0, "ab": -2.0, "c": -1.0, "bc": -2.0})
    assert solve("ab") == (1, -2.0)
    assert solve("abc") == (2, -3.0)
    assert solve("zé")[0] == 3  # unknown: UTF-8 bytes


def test_vocabulary_with_inner_spaces_is_solved_as_a_whole():
    assert unigram_count.segments("a b", False) == ["a▁b"]
    text = " a  b "
    assert "".join("▁" + s for s in unigram_count.segments(text, True)) == "▁" + text.replace(" ", "▁")


@pytest.mark.parametrize("step,overlap", [(16384, 512), (64, 24), (37, 9)])
def test_byte_bpe_equals_the_library_and_round_trips(spark, step, overlap):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_chunks.load_ranks(RANKS), special_tokens={})
    texts = TEXTS + [prose(3, 300) + "z" * 200 + prose(4, 60) + " " * 150 + prose(5, 40), "ab" * 500, "'re" * 100]
    encoded = bpe_chunks.encode(table(spark, texts), RANKS, public_tokenizers.PATTERN, step=step, overlap=overlap)
    got = {r.doc_id: r for r in bpe_chunks.digests(encoded, RANKS).collect()}
    back = {r.doc_id: bytes(r.decoded) for r in bpe_chunks.decode_table(encoded, RANKS).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids), (i, t)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert back[i] == (t or "").encode()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_byte_bpe_repeated_rows_and_null_ids(spark):
    text = prose(6, 200)
    encoded = bpe_chunks.encode(table(spark, [text, text, text], [None, 1, 1]), RANKS, public_tokenizers.PATTERN, step=100, overlap=30)
    rows = encoded.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert len({bytes(r.ids) for r in rows}) == 1


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    hit = [False] * len(words)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            for i in places:
                hit[i:i + 8] = [True] * 8
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeats = len(words), sum(hit)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats,
            n < 20 or 100 * repeats > 30 * n)


def test_quality_measures_match_a_plain_version(spark):
    loop = " ".join(f"w{i % 11}" for i in range(60))
    texts = TEXTS + [loop, prose(1, 30) + "\n" + prose(1, 30), "#a *b\n#a *b\n\n\n#a  *b", prose(7, 400)]
    for r in quality_bands.score(table(spark, texts)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_compression_bands_reject_repetition_and_noise():
    press = zstandard.ZstdCompressor(level=quality_bands.LEVEL).compress
    rng = random.Random(9)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    clean = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(4000))
    assert quality_bands.compression_verdict(clean[:300].encode(), press)[0]
    assert quality_bands.compression_verdict(clean.encode(), press)[0]
    assert not quality_bands.compression_verdict(b"spam ham " * 500, press)[0]
    assert not quality_bands.compression_verdict(np.random.default_rng(1).bytes(5000), press)[0]
    # within the band as a whole, but half of its chunks repeat
    mixed = (clean[:12288] + "spam ham " * 1400).encode()
    assert not quality_bands.compression_verdict(mixed, press)[0]


@pytest.mark.parametrize("size", [600, 800, 1500, 2048, 3400, 8192, 40_000, 270_000])
def test_compression_bands_reject_noise_that_is_text(size):
    press = zstandard.ZstdCompressor(level=quality_bands.LEVEL).compress
    rng = random.Random(size)
    signs = "".join(map(chr, range(33, 127)))
    coded = base64.encodebytes(rng.randbytes(size))[:size]
    words = " ".join("".join(rng.choices(signs, k=rng.randint(2, 10))) for _ in range(size // 3))[:size].encode()
    assert not quality_bands.compression_verdict(coded, press)[0]
    assert not quality_bands.compression_verdict(words, press)[0]
    if size >= 2048:
        assert not quality_bands.compression_verdict("".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(size // 3 + 1)).encode(), press)[0]
    # ideographs as often as in prose, and syllables
    common = rng.sample(range(0x4E00, 0x9FA5), 1500)
    prose_like = "".join(map(chr, rng.choices(common, [1 / (i + 5) for i in range(1500)], k=size // 3))).encode()
    assert quality_bands.compression_verdict(prose_like, press)[0]
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    clean = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(size // 3))[:size].encode()
    assert quality_bands.compression_verdict(clean, press)[0]


def test_compression_bands_judge_the_last_chunk():
    press = zstandard.ZstdCompressor(level=quality_bands.LEVEL).compress
    rng = random.Random(2)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    clean = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(2000))[:4096].encode()
    coded = base64.encodebytes(rng.randbytes(4096))
    assert quality_bands.compression_verdict(clean + coded[:3000], press)[1] > 1.5  # the whole text alone would pass
    assert not quality_bands.compression_verdict(clean + coded[:3000], press)[0]
    assert quality_bands.compression_verdict(clean + coded[:600], press)[0]


def test_keep_good_keeps_columns(spark):
    docs = table(spark, [None, "", prose(7, 400), "spam " * 400])
    kept = quality_bands.keep_good(docs)
    assert kept.schema == docs.schema
    assert [r.doc_id for r in kept.collect()] == [2]


def plain_licenses(text):
    """Every window of the text against every template, by sets."""
    grams, near = license_scan.bigram_list(text or ""), []
    for rank, (name, body) in enumerate(license_scan.TEMPLATES):
        full = license_scan.bigram_list(body)
        known, best = set(full), None
        for n in {len(full), len(full) * 5 // 4, max(len(full), 120 * len(known) // 80)}:
            for p in range(len(grams)):
                own = set(grams[p:p + n])
                common = len(own & known)
                if grams[p] in known and 200 * common >= 80 * (len(own) + len(known)):
                    best = max(best or (0,), (2 * common / (len(own) + len(known)), -p, -n))
        if best:
            near.append((best[0], -rank, name, -best[1], -best[1] - best[2]))
    clear = {h[2] for h in near if not any(o[:2] > h[:2] and o[3] < h[4] and h[3] < o[4] for o in near)}
    likest = max(near, default=(None, 0, None))
    return len(clear), ",".join(sorted(clear)), likest[2], likest[0]


GPL = next(t for n, t in license_scan.TEMPLATES if n == "GPL-3.0" and "redistribute" in t)
MIT = max((t for n, t in license_scan.TEMPLATES if n == "MIT"), key=len)


def wrapped(text, sign):
    return "\n".join(sign + line for line in re.sub(r"(.{30,50}) ", r"\1\n", text).split("\n"))


LICENSED = [
    None, "", "x", prose(1, 60), "intro\nReleased under the MIT License.\nmore", "released UNDER the mit licence, license!",
    wrapped(GPL, "# ") + "\nimport os\n", "/*\n" + wrapped(MIT, " * ") + "\n */\nint x;",
    "See the docs first. This project is licensed under the terms of the MIT license. Have fun with it and more.",
    "// SPDX-License-Identifier: MIT\ncode()", "// SPDX-License-Identifier: BSD-3-Clause\ncode()", "// SPDX-License-Identifier: Foo\ncode()",
    MIT.replace("conditions: ", "conditions:\n\n"), "This work is licensed under the GNU General Public License, version 3.",
    prose(3, 4000) + "\nReleased under the MIT License.\n" + prose(4, 4000) + " Licensed under CC BY-NC 4.0.",
    "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "İstanbul licensed under cc by 4 0",
    "the licence of the software is subject to the terms and conditions of the law " * 30]


def test_license_scan_matches_a_plain_version(spark):
    rows = {r.doc_id: r for r in license_scan.scan(table(spark, LICENSED)).collect()}
    for i, t in enumerate(LICENSED):
        assert tuple(rows[i])[1:4] == plain_licenses(t)[:3], (i, t)
        assert rows[i].dice == plain_licenses(t)[3]
    names = [rows[i].licenses for i in range(len(LICENSED))]
    assert names == ["", "", "", "", "MIT", "", "GPL-3.0", "MIT", "MIT", "MIT", "BSD-3-Clause", "", "MIT", "GPL-3.0",
                     "CC-BY-NC-4.0,MIT", "CC-BY-NC-4.0", "CC-BY-4.0", ""]


def test_license_scan_agrees_with_its_sql(spark):
    import duckdb

    from starloom.llm import queries
    texts = table(spark, LICENSED, [*range(len(LICENSED) - 1), None])
    con = duckdb.connect()
    con.register("documents", texts.toArrow())
    assert sorted(map(str, con.sql(queries.ORACLE["op6_license_scan"]).fetchall())) == sorted(str(tuple(r)) for r in license_scan.scan(texts).collect())


def test_license_scan_takes_a_very_long_text(spark):
    text = "of the software and the terms " * 15000 + MIT
    (row,) = license_scan.scan(table(spark, [text])).collect()
    assert (row.licenses, row.dice) == ("MIT", 1.0)


def test_license_scan_plan_is_native(spark):
    plan = license_scan.scan(table(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert license_scan.scan(table(spark, ["x"]).limit(0)).count() == 0


def test_license_rows_of_one_id_are_joined(spark):
    rows = license_scan.scan(table(spark, ["Released under the MIT License.", "Licensed under CC BY 4.0.", None], [7, 7, None])).collect()
    assert sorted((str(r.doc_id), r.n_licenses) for r in rows) == [("7", 2), ("None", 0)]


TALK = [
    (1, 0, "user", "How do I  sort a list?\nIt is long."),
    (1, 1, "user", "Other question: what is a heap"),
    (1, 2, "assistant", "> how do I sort a list?\n> It is long.\nUse sorted()."),
    (1, 3, "assistant", "> Other question: what is a heap\n\nA tree."),
    (1, 4, "user", "> > It is long.\n> Use sorted().\n\nThanks!"),
    (1, 5, "user", "> nobody said this\nok"),
    (2, 0, "user", None),
    (2, 1, "assistant", ""),
    (2, 2, None, "> Use sorted().\nno link over conversations"),
    (None, 0, "user", "> x"),
    (3, None, "user", "x"),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "assistant", ">same\nyes"),
]


def talk(spark, rows=TALK):
    return spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, thread int")


def test_quotes_link_to_their_messages(spark):
    rows = {(r.conv_id, r.turn): r for r in quote_chat.link_quotes(talk(spark)).collect()}
    got = {k: (r.n_quotes, r.n_linked, r.reply_to, r.thread) for k, r in rows.items()}
    assert got[1, 2] == (1, 1, 0, 0)
    assert got[1, 3] == (1, 1, 1, 1)
    assert got[1, 4] == (2, 2, 2, 0)  # level 1 names turn 2, whose thread begins at turn 0
    assert got[1, 5] == (1, 0, None, 5)
    assert got[2, 2] == (1, 0, None, 2)
    assert got[None, 0] == (0, 0, None, 0)
    assert got[3, None] == (0, 0, None, None)
    assert got[4, 1] == (1, 1, 0, 0)
    assert rows[1, 4].content == "Thanks!" and rows[1, 2].content == "Use sorted()." and rows[2, 0].content == ""


def test_parts_of_messages_link_to_the_latest_holder(spark):
    four = "One line.\nTwo  lines.\nThree lines.\nFour lines."
    rows = [(1, 0, "user", four), (1, 1, "user", "three lines.\nx\ntwo lines."), (1, 2, "user", "> Two lines.\n> three lines.\nyes"),
            (1, 3, "user", f"{four}\n\nAfter a gap."), (1, 4, "user", "> One line.\n> Four lines.\n> After a gap.\nno"),
            (1, 5, "user", "> Two lines.\n> Never said.\nwhat"), (1, 6, "user", "> Four lines.\n> One line.\nback to front"),
            (2, 0, "user", "> Two lines.\n> Three lines.\nother conversation"),
            (1, 7, "user", "> Two lines.\n> Two lines.\ntwice"),
            (3, 0, "user", "> b\n> c\nbefore it"), (3, 1, "user", "a\nb\nc")]
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to, r.thread) for r in quote_chat.link_quotes(talk(spark, rows)).collect()}
    assert got[1, 2] == (1, 1, 0, 0)
    assert got[1, 4] == (1, 1, 3, 3)
    for missing in ((1, 5), (1, 6), (2, 0), (1, 7), (3, 0)):
        assert got[missing] == (1, 0, None, missing[1])


def test_conversations_are_in_reply_order(spark):
    chats = {r.conv_id: r.chat for r in quote_chat.conversations(quote_chat.format_chat(quote_chat.link_quotes(talk(spark)))).collect()}
    order = re.findall("sort a list|sorted|Thanks|heap|tree|ok", chats[1])
    assert order == ["sort a list", "sorted", "Thanks", "heap", "tree", "ok"]
    assert ">" not in re.sub(r"<\|\w+\|>", "", chats[1])


def test_quote_rows_are_kept_and_empty_tables_work(spark):
    assert quote_chat.link_quotes(talk(spark)).count() == len(TALK)
    assert quote_chat.link_quotes(talk(spark).limit(0)).count() == 0


def test_long_reply_chains_reach_their_root(spark):
    rows = [(1, 0, "user", "m0")] + [(1, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 40)]
    assert {r.thread for r in quote_chat.link_quotes(talk(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("run", [
    lambda d: unigram_count.count_tokens(d, PIECES), lambda d: quality_bands.score(d), lambda d: quality_bands.keep_good(d),
    lambda d: bpe_chunks.digests(bpe_chunks.encode(d, RANKS, public_tokenizers.PATTERN), RANKS)])
def test_empty_tables(spark, run):
    assert run(table(spark, ["x"]).limit(0)).count() == 0
