"""DuckDB SQL for the queries that SQL can express, written from their definitions and not from the operators."""

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def low(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({low("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reached),
m AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

LINES = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS pos FROM d),
k AS (SELECT *, {low(f"trim(line, {TRIM})")} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
t AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM t GROUP BY doc_id
"""

EXACT = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm)::BIGINT AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS kept, sha256(norm) AS text_sha256
FROM d
"""

#: Calls and results that queries.exchanges makes of the conversations, linked.
CHAT = """
WITH RECURSIVE u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
lv AS (SELECT u.conv_id, u.turn, 0 AS level FROM u LEFT JOIN u p ON p.conv_id = u.conv_id AND p.turn = u.turn - 2 WHERE p.turn IS NULL
       UNION ALL SELECT u.conv_id, u.turn, lv.level + 1 FROM lv JOIN u ON u.conv_id = lv.conv_id AND u.turn = lv.turn + 2)
SELECT conv_id, turn, -1 AS place, 'message' AS kind, NULL::VARCHAR AS call_id, NULL::INTEGER AS level, 'message' AS status,
       '{"content":' || to_json(CASE WHEN role IN ('user', 'assistant') THEN trim(text) ELSE text END)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || '}' AS json
FROM conversations
UNION ALL
SELECT u.conv_id, u.turn, 0, 'call', 'c' || u.turn, level, CASE WHEN a.turn IS NULL THEN 'unanswered' ELSE 'valid' END,
       '{"arguments":{' || CASE WHEN u.turn >= 2 THEN '"after":{"$ref":"c' || (u.turn - 2) || '"},' ELSE '' END || '"query":' || to_json(u.text)::VARCHAR
       || '},"id":"c' || u.turn || '","name":"search","result":' || coalesce(to_json(a.text)::VARCHAR, 'null') || ',"role":"tool_call"}'
FROM u JOIN lv ON lv.conv_id = u.conv_id AND lv.turn = u.turn LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
UNION ALL
SELECT a.conv_id, a.turn, 0, 'result', 'c' || (a.turn - 1), NULL, 'orphan', '{"content":' || to_json(a.text)::VARCHAR || ',"id":"c' || (a.turn - 1) || '","role":"tool"}'
FROM a LEFT JOIN u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 WHERE u.turn IS NULL
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(l.n - l.u, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0) AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             CASE WHEN word_chars > 0 THEN greatest(0, n_symbols - 4) * 1000 // word_chars ELSE 0 END AS symbols, n_dup_lines * 1000 // (n_lines + 8) AS dup_lines,
             n_repeat_words * 1000 // (n_words + 40) AS repeats, CASE WHEN n_words > 0 THEN floor(500 * ln(word_chars / n_words))::BIGINT ELSE 0 END AS word_length FROM m),
v AS (UNPIVOT (SELECT doc_id, lang, source, base_failed, symbols::BIGINT AS symbols, dup_lines::BIGINT AS dup_lines, repeats::BIGINT AS repeats, word_length::BIGINT AS word_length FROM b)
      ON symbols, dup_lines, repeats, word_length INTO NAME metric VALUE x),
o AS (SELECT * FROM v WHERE NOT base_failed),
levels AS (SELECT 2 AS level, lang, source, metric, x FROM o UNION ALL SELECT 1, lang, NULL, metric, x FROM o UNION ALL SELECT 0, NULL, NULL, metric, x FROM o),
ranked AS (SELECT *, row_number() OVER (PARTITION BY level, lang, source, metric ORDER BY x) AS r, count(*) OVER (PARTITION BY level, lang, source, metric) AS n,
                  CASE WHEN metric IN ('dup_lines', 'repeats') THEN 5 ELSE 100 END AS outside FROM levels),
q AS (SELECT level, lang, source, metric, max(n) AS n, min(x) FILTER (r * 1000 >= n * outside) AS q0, min(x) FILTER (r * 1000 >= n * 250) AS q1,
             min(x) FILTER (r * 1000 >= n * 750) AS q3, min(x) FILTER (r * 1000 >= n * (1000 - outside)) AS q4 FROM ranked GROUP BY level, lang, source, metric),
f AS (SELECT level, lang, source, metric, n, least(q1 - 6 * (q3 - q1), q0) AS low, greatest(q3 + 6 * (q3 - q1), q4) AS high FROM q),
f1 AS (SELECT a.lang, a.metric, floor((a.n * a.low + 20 * z.low) / (a.n + 20)) AS low, floor((a.n * a.high + 20 * z.high) / (a.n + 20)) AS high
       FROM f a JOIN f z ON z.level = 0 AND z.metric = a.metric WHERE a.level = 1),
f2 AS (SELECT a.lang, a.source, a.metric, floor((a.n * a.low + 20 * p.low) / (a.n + 20)) AS low, floor((a.n * a.high + 20 * p.high) / (a.n + 20)) AS high
       FROM f a JOIN f1 p ON p.lang IS NOT DISTINCT FROM a.lang AND p.metric = a.metric WHERE a.level = 2),
odd AS (SELECT doc_id, bool_or(x > coalesce(f2.high, f1.high, z.high) OR v.metric = 'word_length' AND x < coalesce(f2.low, f1.low, z.low)) AS odd
        FROM v LEFT JOIN f2 ON f2.lang IS NOT DISTINCT FROM v.lang AND f2.source IS NOT DISTINCT FROM v.source AND f2.metric = v.metric
        LEFT JOIN f1 ON f1.lang IS NOT DISTINCT FROM v.lang AND f1.metric = v.metric LEFT JOIN f z ON z.level = 0 AND z.metric = v.metric GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(odd, false) AS kept FROM b JOIN odd USING (doc_id)
"""

PASSAGES = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT doc_id, i, md5_number(t[i:i + 199]) AS h FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 198)) AS i FROM d)),
r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
s AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, 0) AS new FROM r),
k AS (SELECT doc_id, i, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM s),
x AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY doc_id, k),
y AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before FROM x),
z AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n, max(b) AS last FROM x GROUP BY doc_id),
parts AS (SELECT y.doc_id, a, hex(t[before:a - 1]) AS part FROM y JOIN d USING (doc_id) WHERE a > before
          UNION ALL SELECT doc_id, octet_length(t) + 1, hex(t[coalesce(last, 1):octet_length(t)]) FROM d LEFT JOIN z USING (doc_id) WHERE coalesce(last, 1) <= octet_length(t)),
left_over AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS kept FROM parts GROUP BY doc_id)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

#: The other queries have none: op4, op6 and op8 encode by vocabularies, op5 adds what inferred grammars find.
ORACLES = {"op1_minhash_near_dedup": NEAR, "op2_line_dedup": LINES, "op3_exact_dedup": EXACT, "op7_tool_calls": CHAT, "op9_quality_rules": QUALITY, "op10_passage_dedup": PASSAGES}
