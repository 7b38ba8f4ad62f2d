"""DuckDB SQL for the queries of this subpackage that SQL can express."""

QUALITY_RULES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
covered AS (SELECT DISTINCT doc_id, i + o AS p FROM counted, (VALUES (0), (1), (2)) AS x(o) WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM covered GROUP BY doc_id),
lines AS (
  SELECT DISTINCT doc_id, line, count(*) OVER (PARTITION BY doc_id, line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
marked AS (
  SELECT *, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    length(regexp_replace(line, '[^#*$%&|<>!]+', '', 'g')) AS marks, length(regexp_replace(line, '[^|»›>]+', '', 'g')) AS bars,
    length(line) <= 300 AND regexp_matches(line, '(?i)\b(all rights reserved|privacy policy|cookie policy|we use cookies|accept (all )?cookies|terms (of use|of service|and conditions)|enable javascript|javascript (is )?(disabled|required)|sign up for our|subscribe to our|click here to|powered by|skip to (main )?content|back to top|lorem ipsum)\b') AS stock
  FROM lines),
judged AS (
  SELECT *, NOT ((marks >= 3 AND marks * 8 > length(line)) OR (bars >= 3 AND length(line) < bars * 30) OR stock) AS good FROM marked),
lost AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines, sum(CASE WHEN good THEN (n - 1) * chars ELSE n * chars END) AS lost FROM judged GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost * 100 <= word_chars * 40 AS kept
FROM v
"""

CHAT_FORMATTING = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_matches(role || ' ' || text, '<s>|</s>|\[INST\]|\[/INST\]|\\[beij\\]') AS hard,
    length(role || text) AS plain,
    length(replace(replace(replace(replace(replace(role || chr(10) || text, '\', '\\'), '<s>', '\b'), '</s>', '\e'), '[INST]', '\i'), '[/INST]', '\j')) - 1 AS safe
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(22 + CASE WHEN hard THEN safe ELSE plain END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

VECTOR_DUPLICATES = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

_ASSIGNED = """
near{k} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, d * 64 + e) AS e, min(d) AS d
  FROM (SELECT vec_id, p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
        FROM parts JOIN book{k} USING (p)) GROUP BY vec_id, p)"""

_MOVED = """
mean{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m
    FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM near{k} JOIN parts USING (vec_id, p)) GROUP BY p, e, i) GROUP BY p, e),
book{next} AS MATERIALIZED (SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e))"""

VECTOR_CODES = (
    """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM kept, range(16) AS r(p)),
book0 AS MATERIALIZED (
  SELECT p, rank - 1 AS e, x AS c FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM kept) USING (vec_id) WHERE rank <= 64),"""
    + ",".join(x.format(k=k, next=k + 1) for k, x in [(0, _ASSIGNED), (0, _MOVED), (1, _ASSIGNED), (1, _MOVED), (2, _ASSIGNED)])
    + """,
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near2 JOIN kept USING (vec_id) GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""
)

CHECKS = {
    "op4_quality_rules": QUALITY_RULES,
    "op5_chat_formatting": CHAT_FORMATTING,
    "op11_vector_duplicates": VECTOR_DUPLICATES,
    "op13_vector_codes": VECTOR_CODES,
}
