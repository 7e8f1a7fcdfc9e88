"""Near dedup, substring dedup, packing, the token store, neighbour search and the pipeline against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import hnsw, minhash_join, packing, quality_bands, queries, substring_cover, token_store
from starloom.llm.common import shared_path
from starloom.llm.components import components

DOCS = "doc_id long, text string, node string, n_words int, label string, slice int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS_JSON = public_tokenizers.path("word_bpe_49k.json")
BYTES_JSON = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, None, 2) for i, t in rows], DOCS)


def corpus(seed=3, n=60):
    """Copies, near copies, chains, shared passages, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base, out = words(60), words(120), []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = words(rng.randint(20, 150))
        elif kind == 1:
            text = list(base)
        elif kind in (2, 3):  # near copies with 1 to 8 changed words
            text = list(base)
            for _ in range(rng.randint(1, 8)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        elif kind == 4:
            text = words(30) + passage + words(30)
        elif kind == 5:
            text = words(5) + passage[7:40] + words(9) + passage[7:30]
        elif kind == 6:
            text = words(rng.randint(0, 6))
        elif kind == 7:
            text = ["Same", "few", "WORDS"] if i % 20 == 7 else ["same", "few", "words"]
        elif kind == 8:  # a chain: each shifts by a few words
            start = i // 10 * 4
            text = [f"c{x}" for x in range(start, start + 60)]
        else:
            text = None if i % 20 == 9 else []
        sep = rng.choice([" ", "\n", "\t "])
        out.append((i, None if text is None else sep.join(text)))
    return out


def plain_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_match_all_pairs(spark, seed):
    rows = corpus(seed, 120)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(table(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_near_duplicates_compare_all_pairs_where_hubs_fail(spark):
    # the hub (smallest id) is near to few of the others, which form pairs of their own
    rng = random.Random(5)
    core = [f"k{i}" for i in range(200)]
    rows = []
    for i in range(24):
        r = random.Random(i // 2)
        text = list(core)
        for at in r.sample(range(200), 7):
            text[at] = f"p{i // 2}.{at}"
        for at in rng.sample(range(200), 1):
            text[at] = f"o{i}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(table(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_near_duplicates_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = minhash_join.near_duplicates(table(spark, [(None, text), (4, text), (4, text), (9, text), (5, "")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("4", "4", True), ("4", "4", True), ("5", "5", True), ("9", "4", False), ("None", "None", True)]
    kept = minhash_join.keep_one(table(spark, [(None, text), (4, text), (9, text)]))
    assert kept.schema == table(spark, []).schema and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "None"]


def test_signature_threshold_loses_no_linked_pair():
    k, p = minhash_join.COORDINATES, minhash_join.SIMILARITY_PCT / 100
    miss = sum(math.comb(k, m) * p**m * (1 - p) ** (k - m) for m in range(minhash_join.MATCHES))
    assert miss < 1e-8


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_substrings(rows):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("slice_chars,bucket_posts", [(8_000_000, 2_000_000), (900, 150)])
def test_substrings_match_a_plain_version(spark, monkeypatch, slice_chars, bucket_posts):
    monkeypatch.setattr(substring_cover, "SLICE_CHARS", slice_chars)
    monkeypatch.setattr(substring_cover, "BUCKET_POSTS", bucket_posts)
    rows = corpus(8, 120)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_cover.measure(table(spark, rows)).collect()}
    assert got == plain_substrings(rows)


def test_cover_has_every_difference():
    assert {(a - b) % substring_cover.PERIOD for a in substring_cover.COVER for b in substring_cover.COVER} == set(range(substring_cover.PERIOD))


def test_substrings_null_ids_repeated_rows_and_clean(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    rows = [(None, a), (3, a), (3, a), (8, f"x\n{a}  y"), (9, a), (10, b), (11, None), (12, "")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_cover.measure(table(spark, rows)).collect())
    assert got == sorted([("None", 20, 0), ("3", 20, 0), ("3", 20, 0), ("8", 22, 20), ("9", 20, 20), ("10", 20, 0), ("11", 0, 0), ("12", 0, 0)])
    kept = substring_cover.clean(table(spark, rows), length_col="n_words")
    assert kept.schema == table(spark, []).schema
    assert {(r.doc_id, r.text, r.n_words) for r in kept.collect()} == {
        (None, a, 1), (3, a, 1), (8, "x y", 3), (10, b, 1), (11, None, 1), (12, "", 1)}
    assert substring_cover.measure(table(spark, [])).count() == 0
    assert substring_cover.clean(table(spark, [])).count() == 0


def check_packing(rows, docs, cap=2048):
    tok = Tokenizer.from_file(WORDS_JSON)
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in docs}
    by_doc = Counter()
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == r.piece * cap and r.length == len(part) == min(cap, len(ids[r.doc_id]) - r.start)
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        by_doc[r.doc_id] += r.length
    assert by_doc == {i: len(x) for i, x in ids.items()}
    filled = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= cap
    return len(filled), math.ceil(sum(by_doc.values()) / cap)


def test_packing_covers_every_document_in_few_sequences(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choices(["stone", "river", "Über", "it's", "42"], k=rng.choice([0, 3, 90, 700, 1500, 4000])))) for i in range(150)]
    docs += [(150, None), (151, ""), (152, "a\x1cb İ ́x"), (153, "<|endoftext |>")]
    used, least = check_packing(packing.pack(table(spark, docs), WORDS_JSON).collect(), docs)
    assert least <= used <= least + max(2, least // 20)
    assert packing.pack(table(spark, []), WORDS_JSON).count() == 0


def test_packing_takes_added_tokens_as_the_library_does(spark):
    texts = ["abc <|endoftext|> def", "a<|endoftext|>b", "A <|ENDOFTEXT|> b", "<|startoftext|><|endoftext|>", " <|startoftext|>\n y,", "<|endoftext|>",
             "e<|endoftext|>\u0301 <|endoftext| > x.<|endoftext|>."]
    docs = list(enumerate(texts))
    check_packing(packing.pack(table(spark, docs), WORDS_JSON).collect(), docs)


def test_packing_repeated_rows_and_null_ids(spark):
    rows = packing.pack(table(spark, [(None, "a b"), (1, "a b"), (1, "a b")]), WORDS_JSON).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6] and len({r.sequence_id for r in rows}) == 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length_and_fits(seed):
    rng = random.Random(seed)
    cap = rng.choice([16, 100, 2048])
    hist = Counter(rng.randint(1, cap) for _ in range(rng.choice([1, 40, 3000])))
    patterns = packing.plan_packing(hist, cap)
    used = Counter()
    for combo, n in patterns:
        assert sum(combo) <= cap and n > 0
        for x in combo:
            used[x] += n
    assert used == hist
    least = max(math.ceil(sum(k * v for k, v in hist.items()) / cap), sum(v for k, v in hist.items() if 2 * k > cap))
    assert sum(n for _, n in patterns) <= math.ceil(1.03 * least) + 1


def test_exact_complements_come_first():
    assert packing.plan_packing({7: 2, 3: 2}, 10) == [((7, 3), 2)]
    assert packing.plan_packing({6: 1, 3: 1, 1: 1}, 10) == [((6, 3, 1), 1)]
    assert packing.plan_packing({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [((4, 3, 2, 1), 1)]
    assert packing.plan_packing({5: 4}, 10) == [((5, 5), 2)]


def test_token_store_round_trip(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "Hello  world\n x ", "  lead", "tab\t\tx \n\n\n  y", "naïve \x1c x\x85 y　 z", "<|endoftext|>", "\n \n"] + [
        " ".join(rng.choices(["the", "stone", "it's", "42", "été", "x\n"], k=rng.randint(1, 400))) for _ in range(60)]
    docs = [(i * 3, t) for i, t in enumerate(texts)]
    tok = Tokenizer.from_file(BYTES_JSON)
    path = shared_path(spark, "store-test")
    token_store.write_store(table(spark, docs[::-1]), path, BYTES_JSON)
    got = {r.doc_id: r for r in token_store.read_store(spark, path).collect()}
    at = 0
    for i, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert bytes(got[i].ids) == ids.tobytes(), t
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    some = token_store.read_store(spark, path, [9, 30, 4]).collect()
    assert {r.doc_id: r.start for r in some} == {9: got[9].start, 30: got[30].start}


def test_token_store_query_takes_added_tokens_as_the_library_does(spark, tmp_path):
    texts = ["abc <|endoftext|> def", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", " <|endoftext|>  z \n", "x <|endoftext| > \n<|endoftext|>.", "q"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tok, at = Tokenizer.from_file(BYTES_JSON), 0
    for r in sorted(queries.op8_token_store(spark, str(tmp_path)).collect()):
        ids = np.array(tok.encode(texts[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_store_empty_repeated_and_null(spark):
    path = shared_path(spark, "store-test")
    token_store.write_store(table(spark, []), path, BYTES_JSON)
    assert token_store.read_store(spark, path).count() == 0
    path = shared_path(spark, "store-test")
    token_store.write_store(table(spark, [(1, "a"), (None, "b c"), (1, "a")]), path, BYTES_JSON)
    assert sorted((str(r.doc_id), r.start) for r in token_store.read_store(spark, path).collect()) == [("1", 3), ("1", 5), ("None", 0)]


def test_token_store_refuses_another_dictionary(spark):
    paths = [shared_path(spark, "store-test") for _ in range(2)]
    token_store.write_store(table(spark, [(1, "some words")]), paths[0], BYTES_JSON)
    token_store.write_store(table(spark, [(1, "other words entirely")]), paths[1], BYTES_JSON)
    spark.read.parquet(f"{paths[1]}/dictionary").write.mode("overwrite").parquet(f"{paths[0]}/dictionary")
    with pytest.raises(Exception, match="written with dictionary"):
        token_store.read_store(spark, paths[0]).collect()


VECTORS = "vec_id long, embedding array<float>, label int, v int, ids int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3) for i, v in rows], VECTORS)


def plain_neighbours(rows, queries, k=10):
    out = {}
    for q, v in queries:
        far = sorted((float(np.sqrt(((np.float64(v) - np.float64(x)) ** 2).sum())), i) for i, x in rows if i != q)
        out[q] = far[:k]
    return out


def test_neighbour_recall_and_exact_scores(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 32))
    data = np.float32(centres[rng.integers(12, size=3000)] + 0.4 * rng.normal(size=(3000, 32)))
    data[500:900] = data[500]  # a large group of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    frame = vectors(spark, rows)
    index = hnsw.build_index(frame, shard_nodes=700).checkpoint()
    assert index.count() > 1 and index.selectExpr("sum(n)").first()[0] == len(np.unique(data, axis=0))
    queries = [(i, v) for i, v in rows if i % 20 == 0]
    got = {}
    for r in hnsw.search(index, frame.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    want, hits = plain_neighbours(rows, queries), 0
    for q, best in want.items():
        assert sorted(got[q]) == list(range(1, 11))
        found = [got[q][k] for k in range(1, 11)]
        assert found == sorted(found) and q not in [i for _, i in found]
        hits += len({i for _, i in found} & {i for _, i in best})
        for s, i in found:
            assert s == pytest.approx(float(np.sqrt(((np.float64(data[q]) - np.float64(data[i])) ** 2).sum())), rel=1e-12, abs=0)
    assert hits >= 0.9 * 10 * len(want)


def test_neighbours_ties_bad_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (5, [0, 1]), (3, [0, 1]), (3, [0, 1]), (4, [1, 0]), (6, None), (7, [0, 0]), (8, [1, None]), (9, [nan, 1]), (10, [inf, 1]), (None, [1, 1])]
    frame = vectors(spark, rows)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in hnsw.search(hnsw.build_index(frame), frame.where("vec_id = 0 or vec_id > 5")).collect())
    assert got == [(0, 1, 4, 0.0), (0, 2, 3, math.sqrt(2)), (0, 3, 5, math.sqrt(2))]
    empty = frame.limit(0)
    assert hnsw.search(hnsw.build_index(empty), empty).count() == 0


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(1)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(70))
    rows = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randint(30, 400)))
        if i % 6 == 1:
            text = rows[i - 1][1] + " tail"
        if i % 6 == 2:
            text = f"{text}\n{passage}\n{text[:50]}"
        if i % 6 == 3:
            text = "spam ham " * 100
        if i % 6 == 4:
            text = None if i % 12 == 4 else "too short"
        rows.append((i, text, "en", "src0", None if text is None else len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    press = quality_bands.zstandard.ZstdCompressor(level=quality_bands.LEVEL).compress
    kept = [(r[0], r[1]) for r in rows if quality_bands.measure(r[1], press)[6]]
    near = plain_components(kept)
    kept = [r for r in kept if near[r[0]][2]]
    removed, final = plain_substrings(kept), []
    stage = docs
    for _, f in corpus_pipeline.STAGES[:3]:
        stage = f(spark, stage, str(tmp_path)).checkpoint()
        assert stage.schema.simpleString() == docs.schema.simpleString()
    texts = {r.doc_id: r for r in stage.collect()}
    for i, t in kept:
        n, gone, sha = removed[i]
        if gone < n:
            assert hashlib.sha256(" ".join(WORD.findall(texts[i].text)).encode()).hexdigest() == sha
            assert texts[i].n_chars == len(texts[i].text)
            final.append((i, texts[i].text))
    assert set(texts) == {i for i, _ in final} and len(final) > 20
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), final)


def test_token_parts_of_letters_and_marks_go_straight_to_the_model():
    tok, asked = Tokenizer.from_file(BYTES_JSON), []

    class Counted:
        model, get_vocab_size = tok.model, tok.get_vocab_size

        def encode(self, text, **kw):
            asked.append(text)
            return tok.encode(text, **kw)

    first = token_store.PartIds(Counted(), 2)
    later = token_store.PartIds(Counted(), 2, " ", first)
    first.LIMIT = later.LIMIT = 5  # parts are dropped and worked out again
    parts = ["été", "Straße,", "stone%%%", "it's", "o'", "naïve!!", "x\nÉlan.", "ÿɏ", "ɐ", "42", "''", "a_b", "été", "", "stone"]
    for held, lead in ((first, ""), (later, " ")):
        for part in parts * 2:
            assert held[part] == np.array(tok.encode(lead + part, add_special_tokens=False).ids, "<u2").tobytes(), part
            assert len(held) <= 5
    # letters never, marks by themselves, all other parts whole
    assert {x.strip() for x in asked} == {",", "%%%", "it's", "'", "!!", "", ".", "ɐ", "42", "''", "a_b"}


def test_token_parts_put_together_are_not_held_and_need_no_depth():
    tok = Tokenizer.from_file(BYTES_JSON)
    first = token_store.PartIds(tok, 2)
    later = token_store.PartIds(tok, 2, " ", first)
    parts = ["sentence.", "Straße,", "x42-", "a.b;", "the.", "one\ntwo", "one\n\ntwo", "\n", "one\n", "ªº.", "ɐ.", "it's", "don't."]
    for part in [*parts, "line\n" * 3_000 + "end."]:  # as deep as there are lines before
        for held, lead in ((first, ""), (later, " ")):
            assert held[part] == np.array(tok.encode(lead + part, add_special_tokens=False).ids, "<u2").tobytes(), part
    assert not {"sentence.", "Straße,", "one\ntwo"} & (set(first) | set(later)) and {"sentence", "Straße"} < set(later)


def test_white_space_before_spaces_is_found():
    spaces = [chr(n) for n in range(0x110000) if chr(n).isspace()]
    for x in [*spaces, "a", "é", "ɏ", "\u200b", "ツ", "\U0001f600"]:
        for text in (f"some{x} more", f"some {x}more", f"{x} ", f"é{x}", f"some é{x} "):
            assert token_store.space_after_space(text) == bool(token_store.SPACE_AFTER_SPACE.search(text)), repr(text)
