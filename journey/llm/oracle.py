"""DuckDB SQL of the operators' contracts where SQL can express them, over the raw tables."""

from __future__ import annotations

# op2: shingles as strings, candidate pairs through shared shingles, components by a recursive walk
JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM words WHERE len(w) > 0),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b
          WHERE 100 * p.n >= 85 * (len(x.s) + len(y.s) - p.n)),
walk(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT w.a, l.b FROM walk w JOIN links l ON l.a = w.b)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sets s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM walk GROUP BY a) c ON c.a = d.doc_id
"""

# op3: escaped lengths from the template's definition
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g')) + 1
      + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# op6: base counts from lists; the hosts' beta prior from the moments of their rates, the verdict from its lower limit
RULES = r"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
wins AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id),
judged AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f, sum(base_failed::INT) / count(*) AS r FROM judged GROUP BY source),
moments AS (SELECT avg(r) AS m, var_samp(r) AS v, avg(1 / n) AS c FROM hosts),
prior AS (SELECT m, CASE WHEN v IS NULL OR c >= 1 THEN 2.0 WHEN m <= 0 OR m >= 1 OR v / (m * (1 - m)) <= c THEN 10000.0
          ELSE least(10000.0, greatest(2.0, (1 - c) / (v / (m * (1 - m)) - c) - 1)) END::DOUBLE AS k FROM moments),
shrunk AS (SELECT source, (f + m * k) / (n + k) AS p, n + k AS s FROM hosts, prior),
rates AS (SELECT source, p - 2.326 * sqrt(p * (1 - p) / (s + 1)) AS low FROM shrunk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND low <= 0.5) AS kept
FROM judged j JOIN rates r ON r.source IS NOT DISTINCT FROM j.source
"""

# op7: all windows of items and texts meet by equality, one window length at a time
CONTAMINATION = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pats AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM pats),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wins AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
         FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, sizes)),
found AS (SELECT w.doc_id, w.i, w.m, p.item FROM wins w JOIN pats p ON p.m = w.m AND p.g = w.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

ORACLE_SQL = {
    "op2_ngram_jaccard": JACCARD,
    "op3_chat_format": CHAT,
    "op6_host_rules": RULES,
    "op7_wu_manber": CONTAMINATION,
}
