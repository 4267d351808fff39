"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM by_source
), capped AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / w AS cap FROM weighed
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(3 * source_size) OVER (ORDER BY cap, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / sum(w) OVER (ORDER BY cap, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM capped
), held AS (
  SELECT max(level) AS level FROM levels WHERE level <= cap
), targets AS (
  SELECT source, source_size, coalesce(least(CAST(3 * source_size AS DOUBLE), held.level * w), CAST(3 * source_size AS DOUBLE)) AS target FROM levels, held
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM targets
), draws AS (
  SELECT s.doc_id, s.source, s.size, r.source_size, r.target, CAST(floor(r.rate) AS INTEGER) AS whole, r.rate - floor(r.rate) AS fraction, k,
    CAST(('0x' || substr(md5(k || ':' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source, range(8) t(k)
), misses AS (
  SELECT source, k, abs(max(whole) * max(source_size) + sum(CASE WHEN u < fraction THEN size ELSE 0 END) - max(target)) AS miss FROM draws GROUP BY source, k
), chosen AS (
  SELECT source, arg_min(k, (miss, k)) AS k FROM misses GROUP BY source
)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST((d.whole + CASE WHEN d.u < d.fraction THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM draws d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.k = c.k
"""

JACCARD = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded
), points AS (
  SELECT md5(array_to_string(list_sort(s), chr(10))) AS p, min(doc_id) AS least, any_value(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 1
), items AS (
  SELECT p, n, unnest(s) AS x FROM points
), shared AS (
  SELECT a.p AS u, b.p AS v, max(a.n) AS n, max(b.n) AS m, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.p <> b.p GROUP BY a.p, b.p
), links AS (
  SELECT u, v FROM shared WHERE 100 * c >= 75 * (n + m - c)
), reach(p, least) AS (
  SELECT p, least FROM points
  UNION
  SELECT l.v, r.least FROM reach r JOIN links l ON l.u = r.p
), named AS (
  SELECT p, min(least) AS component_id FROM reach GROUP BY p
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE n.component_id END AS component_id
FROM sets s LEFT JOIN named n ON n.p = md5(array_to_string(list_sort(s.s), chr(10)))
"""

LINES = rf"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM worded)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), parts AS (
  SELECT r, host, md5(text) AS fp, l, regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS lw
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS l FROM worded)
), held AS (
  SELECT r, host, fp, l, array_to_string(lw, ' ') AS line, len(lw) AS n FROM parts WHERE len(lw) > 0
), dups AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM held GROUP BY r
), hosts AS (
  SELECT host, count(DISTINCT md5(text)) AS n FROM worded GROUP BY host
), frequent AS (
  SELECT h.host, h.line FROM held h JOIN hosts USING (host) GROUP BY h.host, h.line, hosts.n
  HAVING count(DISTINCT fp) > 20 AND (count(DISTINCT fp) > hosts.n * 0.05::DOUBLE OR count(DISTINCT fp) > 1000)
), lost AS (
  SELECT r, sum(n) AS n FROM held JOIN frequent USING (host, line) GROUP BY r
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(w) - coalesce(lost.n, 0) AS BIGINT) AS kept_words
  FROM worded LEFT JOIN dups USING (r) LEFT JOIN covered USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, kept_words,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_words >= n_words * 0.5::DOUBLE AS kept
FROM counted
"""

NEIGHBOURS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.r AS u, b.r AS w FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93::DOUBLE
), reach(r, least) AS (
  SELECT r, vec_id FROM v
  UNION
  SELECT l.w, x.least FROM reach x JOIN links l ON l.u = x.r
), named AS (
  SELECT r, min(least) AS component_id FROM reach GROUP BY r
), counted AS (
  SELECT u AS r, count(*) AS n_links FROM links GROUP BY u
)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, coalesce(v.vec_id = component_id, FALSE) AS kept
FROM v JOIN named USING (r) LEFT JOIN counted USING (r)
"""

ORACLE = {"op1_mix_sources": MIX, "op3_embedding_neighbours": NEIGHBOURS, "op7_ngram_jaccard": JACCARD, "op8_line_frequency": LINES}
