"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import (bpe_chunks, collocations, hnsw, license_scan, minhash_join, packing, pii_spans, quality_bands,
                          quote_chat, spelling_groups, substring_cover, token_store, unigram_count)
from starloom.llm.common import read_table, shared_path


def op1_token_counts(spark, sf_dir):
    return unigram_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_chunks.digests(bpe_chunks.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)


def op3_quote_chat(spark, sf_dir):
    linked = quote_chat.link_quotes(read_table(spark, sf_dir, "conversations"))
    return quote_chat.format_chat(linked).drop("content")


def op4_minhash_near_dedup(spark, sf_dir):
    return minhash_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark, sf_dir):
    return substring_cover.measure(read_table(spark, sf_dir, "documents"))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_store(spark, sf_dir):
    path = shared_path(spark, "token-store")
    token_store.write_store(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_store(spark, path, with_ids=False)


def op9_compression_quality(spark, sf_dir):
    return quality_bands.score(read_table(spark, sf_dir, "documents"))


def op10_hnsw_neighbours(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    index = hnsw.settle(hnsw.build_index(vectors))
    return hnsw.search(index, vectors.where(F.col("vec_id") % 100 == 0))


def op11_spelling_variants(spark, sf_dir):
    return spelling_groups.variants(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_pii_spans(spark, sf_dir):
    return pii_spans.digests(pii_spans.find(read_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_byte_bpe, op3_quote_chat, op4_minhash_near_dedup, op5_substring_dedup,
    op6_license_scan, op7_best_fit_packing, op8_token_store, op9_compression_quality, op10_hnsw_neighbours,
    op11_spelling_variants, op12_collocations, op13_pii_spans)}

WORDS = "string_split_regex(trim(coalesce(text, ''), E' \\t\\n\\x0B\\f\\r'), '[\\x20\\x09-\\x0D]+')"

OP4_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT doc_id, list_filter({WORDS}, lambda x: x <> '') AS w FROM worded
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words
), posts AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM posts a JOIN posts b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM sets
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.node
"""

OP5_SQL = f"""
WITH words AS (
  SELECT doc_id, list_filter({WORDS}, lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i+12], ' '))) AS g
  FROM words WHERE len(w) >= 13
), first AS (SELECT g, min(doc_id) AS doc_id FROM windows GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM (SELECT w.doc_id, w.i FROM windows w JOIN first f ON w.g = f.g WHERE w.doc_id > f.doc_id)
), gone AS (SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id),
each AS (SELECT doc_id, w, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT e.doc_id, string_agg(e.x, ' ' ORDER BY e.i) AS text FROM each e ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def _license_sql(templates=license_scan.TEMPLATES, pct: int = license_scan.THRESHOLD_PCT) -> str:
    """Every window of every text against every template, without any pruning."""
    quoted = ", ".join("({}, '{}', '{}')".format(i, n.replace("'", "''"), t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    norm = "list_filter(string_split(trim(regexp_replace(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH templates AS (
  SELECT rank, license, list_distinct(g) AS t, list_distinct([len(g), len(g) * 5 // 4, greatest(len(g), {200 - pct} * len(list_distinct(g)) // {pct})]) AS sizes
  FROM (SELECT rank, license, {grams} AS g FROM (SELECT rank, license, {norm.format('body')} AS w FROM (VALUES {quoted}) v(rank, license, body)))
), texts AS (SELECT doc_id, u, {grams} AS g FROM (SELECT doc_id, row_number() OVER () AS u, {norm.format('text')} AS w FROM documents)
), starts AS (
  SELECT doc_id, u, g, rank, license, t, sizes, unnest(list_filter(range(1, len(g) + 1), lambda p: list_contains(t, g[p]))) AS p FROM texts, templates
), units AS (SELECT doc_id, u, rank, license, t, p, n, list_distinct(g[p:p + n - 1]) AS b FROM (SELECT *, unnest(sizes) AS n FROM starts)
), hits AS (
  SELECT doc_id, u, rank, license, p, n, 2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM units WHERE 200 * len(list_intersect(b, t)) >= {pct} * (len(b) + len(t))
), near AS (
  SELECT doc_id, u, rank, license, max(dice) AS dice, arg_max(p, (dice, -p, -n)) AS p, arg_max(p + n, (dice, -p, -n)) AS stop
  FROM hits GROUP BY doc_id, u, rank, license
), best AS (SELECT doc_id, arg_max(license, (dice, -rank)) AS license, max(dice) AS dice FROM near GROUP BY doc_id
), clear AS (
  SELECT doc_id, count(DISTINCT license) AS n_licenses, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM near h
  WHERE NOT EXISTS (SELECT 1 FROM near o WHERE o.u = h.u AND o.p < h.stop AND h.p < o.stop AND (o.dice > h.dice OR (o.dice = h.dice AND o.rank < h.rank)))
  GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_licenses, 0) AS n_licenses, coalesce(c.licenses, '') AS licenses, b.license, b.dice
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN best b ON d.doc_id IS NOT DISTINCT FROM b.doc_id LEFT JOIN clear c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
"""


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), phrases AS (
  SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS p FROM worded
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM worded
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM worded
), f AS (SELECT lang, p, CAST(count(*) AS BIGINT) AS f FROM phrases GROUP BY lang, p HAVING count(*) >= 10
), cuts AS (SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
), scores AS (
  SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON c.lang = l.lang AND c.p[1:c.k] = l.p JOIN f r ON c.lang = r.lang AND c.p[c.k + 1:] = r.p
), lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, p[1:2] AS p, f AS a FROM f WHERE len(p) = 3 UNION ALL SELECT lang, p[2:3], f FROM f WHERE len(p) = 3) GROUP BY lang, p
), ranked AS (
  SELECT s.*, array_to_string(s.p, ' ') AS phrase, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, array_to_string(s.p, ' ')) AS rank
  FROM lowest s LEFT JOIN longer g ON s.lang = g.lang AND s.p = g.p WHERE g.longer IS NULL OR 100 * g.longer < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op4_minhash_near_dedup": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op6_license_scan": _license_sql(),
          "op12_collocations": OP12_SQL}
