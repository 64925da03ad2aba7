"""SQL for the corpus operators that SQL can express on whole tables.

Each statement follows an operator's contract literally (every window, every
shingle, every pair of sets that share one), so it shares no method with the
operator that it is compared with.
"""

from __future__ import annotations

SUFFIX_DEDUP = r"""
WITH docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
cuts AS (SELECT doc_id, h, length(h) // 2 AS size, unnest(range(0, length(h) // 2, 500)) AS c FROM docs),
pieces AS (SELECT doc_id, size, c, h[2 * c + 1 : 2 * c + 1198] AS h FROM cuts),
bytes AS (SELECT doc_id, size, c, h, unnest(range(c + 1, least(c + 500, size) + 1)) AS p FROM pieces),
windows AS (SELECT doc_id, p, h[2 * (p - c) - 1 : 2 * (p - c) + 198] AS s FROM bytes WHERE p + 99 <= size),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1),
marked AS (
  SELECT b.doc_id, b.p, b.h[2 * (b.p - b.c) - 1 : 2 * (b.p - b.c)] AS byte,
    max(later.p) OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM bytes b LEFT JOIN later ON b.doc_id = later.doc_id AND b.p = later.p),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), FALSE) AS begins FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS h
  FROM runs GROUP BY doc_id)
SELECT docs.doc_id, CAST(length(docs.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

JACCARD_JOIN = r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p, len(w) AS size FROM docs),
grams AS (
  SELECT doc_id, p, size, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM words),
sets AS (SELECT DISTINCT doc_id, s FROM grams WHERE p <= greatest(size - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes m ON a = m.doc_id JOIN sizes n ON b = n.doc_id WHERE 100 * common >= 75 * (m.n + n.n - common)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT r.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id FROM reached r LEFT JOIN sizes ON r.doc_id = sizes.doc_id GROUP BY r.doc_id"""

DECONTAMINATION = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, array_to_string(w[s : s + 9], ' ') AS x, len(w[s : s + 9]) AS k FROM starts),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
tails AS (
  SELECT doc_id, p, array_agg(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS t FROM words),
places AS (
  SELECT doc_id, p, k, array_to_string(t[1:k], ' ') AS x FROM tails JOIN (SELECT DISTINCT k FROM windows) ON len(t) >= k),
hits AS (SELECT doc_id, p, k, item_id FROM places JOIN windows USING (x, k)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)"""

WINDOW_DEDUP = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
windows AS (
  SELECT doc_id, p, word, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
counted AS (SELECT doc_id, p, word, n = 35 AND count(*) OVER (PARTITION BY s, n) > 1 AS twice FROM windows),
marked AS (SELECT doc_id, p, word, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS k FROM marked GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""
