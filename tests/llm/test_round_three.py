"""Operators 11 to 13 against brute force, and their edge cases."""

import collections
import gc
import hashlib
import random
import re
import weakref
import zlib

import numpy as np
import pytest

from starloom.llm import collocations as co
from starloom.llm import pii_spans as pii
from starloom.llm import spelling_groups as sg

LOWER = {i: i + 32 for i in range(65, 91)}
SF = "/root/testdata/sf0.001"


def whole(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


# --- spelling ------------------------------------------------------------------

def plain_variants(rows):
    c = collections.Counter()
    for i, x in rows:
        for m in re.findall("[A-Za-zÀ-ÿ]+", x or ""):
            m = m.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{m}".encode())
            if h % 199 == 0:
                m = m[:h % len(m)] + m[h % len(m) + 1:]
            c[m] += 1
    c = {k: v for k, v in c.items() if len(k) >= 6 and v >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if a == b or len(b) - len(a) > 1:
            return False
        p = next((p for p in range(len(a)) if a[p] != b[p]), len(a))
        return a[p + (len(a) == len(b)):] == b[p + 1:]

    out, form = set(), {}
    for k in c:
        s = [x for x in c if near(k, x)]
        best = min(s, key=lambda x: (-c[x], x), default=None)
        form[k] = (best if best and c[best] >= 5 * c[k] else None, len(s))
    for k in c:
        root = k
        while form[root][0]:
            root = form[root][0]
        out.add((k, form[k][0], root, c[k], form[k][1], c[form[k][0]] if form[k][0] else None))
    return out


def spelled(spark, rows, **kw):
    got = sg.variants(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect()
    assert len(got) == len({r["word"] for r in got})
    return {tuple(r) for r in got}


@pytest.mark.parametrize("group", [4000, 3])
def test_variants_match_brute_force(spark, group):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=300)) + " STRASSE Aaaaaa aaaaaaa") for i in range(60)]
    assert spelled(spark, rows, group=group) == plain_variants(rows)


def test_variants_follow_forms_to_the_root(spark):
    rows = [(1, "kitten " * 3000 + "kittan " * 500 + "kittam " * 60 + "kittzm " * 7 + "other " * 3)]
    got = {r[0]: r for r in spelled(spark, rows)}
    assert got["kittzm"][1:3] == ("kittam", "kitten") and got["kitten"][1:3] == (None, "kitten")
    assert spelled(spark, rows) == plain_variants(rows)


def test_variants_edge_cases(spark):
    assert spelled(spark, []) == set()
    rows = [(1, None), (2, ""), (None, "letters " * 9), (3, "letters " * 6), (3, "letters " * 6), (4, "x" * 50000), (5, "lettersx " * 5)]
    assert spelled(spark, rows) == plain_variants(rows)
    extra = spark.createDataFrame([(1, "letters " * 9, "a", 3)], "doc_id long, text string, word string, n int")
    assert [tuple(r)[:1] for r in sg.variants(extra).collect()] == [("letters",)]


def test_sorted_list_finds_all_pairs():
    rng = random.Random(1)
    for _ in range(300):
        parts = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 25))})

        def dist(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                new = [i]
                for j, y in enumerate(b, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
                row = new
            return row[-1]

        want = {(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts)) if dist(parts[i], parts[j]) == 1}
        assert set(sg.near_in_list(parts)) == want


# --- collocations ----------------------------------------------------------------

def plain_collocations(rows):
    f, n = collections.Counter(), collections.Counter()
    for x, lang in rows:
        lang = "und" if lang is None else lang
        for p in re.split("[.,;:!?\n-\r]", (x or "").translate(LOWER)):
            w = re.findall("[^ \t]+", p)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i:i + k])] += 1
    often = {k: v for k, v in f.items() if v >= 10}
    longer = collections.Counter()
    for k, v in often.items():
        if len(k) == 4:
            for s in (k[:3], (k[0], *k[2:])):
                longer[s] = max(longer[s], v)
    ranked = collections.defaultdict(list)
    for k, a in often.items():
        if len(k) > 2 and 100 * longer.get(k, 0) < 50 * a:
            s, _, lo, r = min((1000000 * a * a // (f[k[:j]] * f[(k[0], *k[j:])]), j, f[k[:j]], f[(k[0], *k[j:])]) for j in range(2, len(k)))
            ranked[k[0]].append((-s, -a, " ".join(k[1:]).encode(), lo, r))
    return {(lang, i + 1, p.decode(), -a, lo, r, n[lang], -s) for lang, v in ranked.items() for i, (s, a, p, lo, r) in enumerate(sorted(v)[:2000])}


def mined(spark, rows, **kw):
    got = co.collocations(spark.createDataFrame(rows, "text string, lang string"), **kw).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("range_windows", [2_000_000, 3000])
def test_collocations_match_brute_force(spark, range_windows):
    rows = [(t, lang) for _, t, lang in whole(spark)]
    assert mined(spark, rows, range_windows=range_windows) == plain_collocations(rows)


def test_collocations_in_small_shards_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(co, "HELD", 700)
    monkeypatch.setattr(co, "ASKED", 40)
    rng = random.Random(3)
    words = ["the", "of", "a", "cat", "dog", "\x01x", "é", "Über"]
    rows = [(" ".join(rng.choices(words, k=4000)) + ".", "en"), ("hot pair " * 3000, None)] + [(" \t".join(rng.choices(words, k=40)), "fr") for _ in range(60)]
    assert mined(spark, rows, range_windows=1500) == plain_collocations(rows)


def test_collocations_edge_cases(spark):
    assert mined(spark, []) == set()
    rows = [(None, "en"), ("", None), (".,;", "fr"), ("a b\x0bc " * 12, None), ("a b\x0bc " * 12, None)]
    assert mined(spark, rows) == plain_collocations(rows)
    extra = spark.createDataFrame([("x y " * 20, "en", 1, "z")], "text string, lang string, n int, words string")
    assert {tuple(r) for r in co.collocations(extra).collect()} == plain_collocations([("x y " * 20, "en")])


def test_automata_unite_and_travel():
    ids = co.Ids()
    words = "b a b c \n a b a".split(" ")
    import numpy as np
    numbers = np.fromiter(map(ids.__getitem__, words), np.int64)
    one = co.Automaton.from_windows(co.windows_of(numbers), [w for w in ids if w not in ("", "\n")])
    back = co.Automaton.from_row(one.to_row())
    assert (back.vocabulary, back.keys.tolist(), back.weights.tolist()) == (one.vocabulary, one.keys.tolist(), one.weights.tolist())
    both = dict(co.Automaton.union([one, back]).phrases(1, False))
    assert both[("a",)] == 6 and both[("a", "b")] == 4 and both[("b", "a", "b")] == 2 and ("c", "a") not in both


# --- personal data ---------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = [f"email:{m.start()}:{m.end()}" for m in EMAIL.finditer(text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in IP.finditer(text) if max(map(int, m.group().split("."))) <= 255]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(f"card:{m.start()}:{m.end()}")
    out += [f"phone:{m.start()}:{m.end()}" for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def spans(spark, texts):
    rows = list(enumerate(texts))
    return {r["doc_id"]: r for r in pii.digests(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}


def agree(row, text):
    want = base_spans(text or "")
    assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x.startswith(k + ":") for x in want) for k in pii.BASE_KINDS]
    assert set(want) <= set(row["spans"].split(",") if row["spans"] else [])


def test_base_spans_match_plain_patterns(spark):
    rng = random.Random(9)
    bits = ["a@b.c", "@", "a.b", ".", "-", "+", "1", "255", "256", " ", "(", ")", "4111 1111 1111 1111", "+1 (555) 123-4567", "é", "x_y%", "00", "\n", "1.2.3.4"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(1500)] + [t for _, t, _ in whole(spark)] + [None, ""]
    got = spans(spark, texts)
    for i, t in enumerate(texts):
        agree(got[i], t)


def test_added_spans(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 IS MY", "IBAN DE88 3704 0044 0532 0130 00 IS MY", "ssn 123-45-6789", "order 123-45-6789",
             "call 415-555-2671 or (415) 555-2671", "415-555-2671", "john (at) example (dot) com", "2001:db8:0:1:1:1:1:1",
             "id 2023 4111 1111 1111 1111 12", "card 3782 822463 10005", "+1 (415) 555-2671"]
    got = spans(spark, texts)
    assert [got[i]["spans"] for i in range(len(texts))] == [
        "iban:5:32", "", "ssn:4:15", "", "phone:5:17,phone:21:35", "", "email:0:27", "ip:0:20", "card:8:27", "card:5:22", "phone:0:17"]


def test_very_long_texts(spark):
    texts = ["1.2.3.4 " * 3000, "1" * 100000, "a@b" + ".c" * 50000, "+1" + "(" * 100000, "1 " * 30000, "x" * 100000 + "@"]
    got = spans(spark, texts)
    for i, t in enumerate(texts[:5]):
        agree(got[i], t)
    assert got[5]["spans"] == ""


def test_nulls_and_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "a@b.c", 1, "x"), (None, "a@b.c", 1, "x"), (2, None, 2, "y")], "doc_id long, text string, base int, spans string")
    got = pii.digests(pii.find(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["spans"]) for r in got) == [(0, "email:0:5"), (0, "email:0:5"), (2, "")]
    assert pii.find(rows.limit(0)).count() == 0


def test_automata_rows_are_compressed():
    for numbers in ([], [0], [5, 0, 255, 256], [1 << 40, 3], [(1 << 62) + 7, 0]):
        assert co.unpressed(co.pressed(np.array(numbers, np.int64))).tolist() == numbers
    rng = np.random.default_rng(3)
    numbers = np.minimum(rng.zipf(1.4, 60_000), 9_000)
    one = co.Automaton.from_windows(co.windows_of(numbers), [f"mot{n}é" for n in range(9_000)])
    row = one.to_row()
    back = co.Automaton.from_row(row)
    assert back.vocabulary == one.vocabulary and (back.keys == one.keys).all() and (back.weights == one.weights).all()
    assert sum(map(len, row)) < 6 * len(one.keys)


def test_automata_are_united_one_after_another():
    rng = np.random.default_rng(5)
    names = [f"w{n}" for n in range(20_000)]
    rows = []
    for _ in range(10):
        numbers = (rng.zipf(1.3, 40_000) % len(names) + 1).astype(np.int32)
        columns = co.windows_of(numbers)
        assert {x.dtype for x in columns} == {np.dtype(np.int32)}
        rows.append(co.Automaton.from_windows(columns, names))
        assert not columns  # taken, so that they don't stay beside the keys
    alive = weakref.WeakSet()

    def one_by_one():
        for x in rows:
            gc.collect()
            assert len(alive) <= 1
            new = co.Automaton.from_row([memoryview(b) for b in x.to_row()])
            alive.add(new)
            yield new
            del new

    whole = co.Automaton.union(one_by_one())
    assert whole.weights.dtype == np.int64 and whole.weights.sum() == 400_000
    assert whole.vocabulary == sorted(set().union(*(x.vocabulary for x in rows))) and (np.diff(whole.keys) > 0).all()
    counts = collections.Counter()
    for x in rows:
        counts.update(dict(x.phrases(1, False)))
    assert dict(whole.phrases(1, False)) == counts
