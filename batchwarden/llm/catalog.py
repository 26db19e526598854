"""Registered queries of this package, and their comparison SQL where SQL can state them."""

from __future__ import annotations

from batchwarden.llm.embeddings import op10_embedding_near_dedup
from batchwarden.llm.hard_negatives import op12_hard_negatives
from batchwarden.llm.html import op1_html_extract
from batchwarden.llm.huffman import op3_token_id_files
from batchwarden.llm.language_model import op9_language_model_scores
from batchwarden.llm.packing import op4_best_fit_packing
from batchwarden.llm.pii import op7_pii_sanitise
from batchwarden.llm.prefix_trie import op11_prefix_trie
from batchwarden.llm.quality import op6_quality_rules
from batchwarden.llm.quality_network import op13_quality_network
from batchwarden.llm.sentencepiece import op2_sentencepiece_codec
from batchwarden.llm.simhash import op8_simhash_near_dedup
from batchwarden.llm.warc import op5_warc_archive

QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extract,
        op2_sentencepiece_codec,
        op3_token_id_files,
        op4_best_fit_packing,
        op5_warc_archive,
        op6_quality_rules,
        op7_pii_sanitise,
        op8_simhash_near_dedup,
        op9_language_model_scores,
        op10_embedding_near_dedup,
        op11_prefix_trie,
        op12_hard_negatives,
        op13_quality_network,
    )
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op6_quality_rules": rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
m AS (
  SELECT b.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '\P{{L}}', '', 'g')) AS n_letters,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
  FROM base b LEFT JOIN covered c ON b.doc_id = c.doc_id),
v AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END)
    + (CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > n_letters THEN 64 ELSE 0 END)
    + (CASE WHEN 10 * n_exclamations > n_words THEN 128 ELSE 0 END) AS b
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_letters AS BIGINT) AS n_letters,
       CAST(n_capitals AS BIGINT) AS n_capitals, CAST(n_exclamations AS BIGINT) AS n_exclamations,
       CAST(b AS BIGINT) AS bits, (b & 3) <> 0 AS base_failed, b = 0 AS kept
FROM v
""",
    "op10_embedding_near_dedup": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len([x FOR x IN embedding IF isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(l.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN lowest l ON e.vec_id = l.a
""",
    "op11_prefix_trie": rf"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT b, 0, b FROM range(256) AS t(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS t FROM conversations WHERE conv_id IS NOT NULL),
crc(c, t, i, v) AS (
  SELECT c, t, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT c, t, i + 1, xor(crc.v >> 8, bits.v) FROM crc JOIN bits ON bits.k = 8 AND bits.b = xor(crc.v, ascii(substr(t, i + 1, 1))) & 255
  WHERE i < length(t)),
heads AS (SELECT c, c - c % 20 AS base, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = length(t)),
turns AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (
  SELECT h.c, t.p, t.d, t.w FROM heads h JOIN turns t ON t.c = h.base AND t.p <= h.h
  UNION ALL
  SELECT h.c, t.p + 1000000000, t.d, t.w FROM heads h JOIN turns t ON t.c = h.c AND t.p > h.h),
paths AS (
  SELECT c, row_number() OVER w AS depth, string_agg(d, ' ') OVER w AS path, w AS words, count(*) OVER (PARTITION BY c) AS n
  FROM built WINDOW w AS (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING)),
steps AS (
  SELECT c, depth, path, coalesce(lag(path) OVER (PARTITION BY c ORDER BY depth), '') AS above, words, n FROM paths
  UNION ALL
  SELECT h.c, 0, '', NULL, 0, coalesce(x.n, 0) FROM heads h LEFT JOIN (SELECT c, max(n) AS n FROM paths GROUP BY c) x ON x.c = h.c),
nodes AS (
  SELECT path, min(c) AS c, min(depth) AS depth, min(above) AS above, count(*) AS n, min(words) AS words,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE depth = steps.n), '') AS ends
  FROM steps GROUP BY path),
leaves AS (SELECT path FROM nodes WHERE path NOT IN (SELECT above FROM nodes WHERE above IS NOT NULL)),
children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
under AS (
  SELECT a.path, sum((b.n - 1) * b.words) AS saved, count(l.path) AS leaves
  FROM nodes b JOIN (SELECT DISTINCT s.path AS low, t.path FROM steps s JOIN steps t ON s.c = t.c AND t.depth <= s.depth) a ON a.low = b.path
  LEFT JOIN leaves l ON l.path = b.path GROUP BY a.path)
SELECT v.c AS conv_id, CAST(v.depth AS BIGINT) AS depth, u.c AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(x.leaves AS BIGINT) AS n_leaves,
       CAST(x.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON u.path = v.above LEFT JOIN children k ON k.path = v.path JOIN under x ON x.path = v.path
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len([x FOR x IN embedding IF isnan(x) OR isinf(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.other_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
""",
}
