"""SQL, as DuckDB runs it, for the queries that SQL can express; the others are tested against plain versions."""

from __future__ import annotations

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = f"""WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
 p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {LOWER}) AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
 u AS (SELECT DISTINCT host, path FROM p),
 f AS (SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY u.host, u.path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.host = f.host AND p.path = f.path"""

OP3 = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
 s AS (SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) + length('<s>[INST]') + length('[/INST]') + length('</s>') + 1 AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars FROM s GROUP BY conv_id"""

OP4 = r"""WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 8))::BIGINT >> 2 AS h FROM documents),
 s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
 w AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight FROM s),
 r AS (SELECT *, source_size * 3 AS cap, source_size * 3.0::DOUBLE / weight AS ratio, row_number() OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source IS NULL, source) AS nth FROM w),
 l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
 v AS (SELECT (SELECT arg_min(level, nth) FROM l WHERE level <= ratio) AS level),
 t AS (SELECT source, source_size, CASE WHEN v.level IS NULL OR weight * v.level > cap THEN cap::DOUBLE ELSE weight * v.level END AS target FROM r, v),
 b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM t),
 e AS (SELECT *, target - times * source_size AS rest FROM b),
 g AS (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY source, h),
 c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
 x AS (SELECT c.source, min({'h': h, 'upto': upto, 'words': words, 'rest': rest}) AS m FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source WHERE rest > 0 AND upto >= rest GROUP BY c.source),
 y AS (SELECT source, CASE WHEN m.upto - m.rest <= m.rest - (m.upto - m.words) THEN m.h ELSE m.h - 1 END AS last_h FROM x)
SELECT doc_id, size, source_size, target, (size * (times + CASE WHEN h <= coalesce(last_h, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN y ON d.source IS NOT DISTINCT FROM y.source"""

WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
OP7 = f"""WITH i AS (SELECT item_id, {WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {WORDS} AS w FROM documents),
 iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[a + 1:a + 13], ' ') AS x FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS a FROM i WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT n FROM iw),
 dw AS (SELECT doc_id, n, a, array_to_string(w[a + 1:a + n], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS a FROM d, sizes)),
 m AS (SELECT doc_id, dw.n, a, x FROM dw WHERE x IN (SELECT x FROM iw)),
 h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM m) GROUP BY doc_id),
 k AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT m.doc_id, iw.item_id::VARCHAR AS item_id FROM m JOIN iw ON m.x = iw.x AND m.n = iw.n) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""

OP9 = f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[a + 1:a + 3], ' ')) AS x FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS a FROM d WHERE len(w) > 0)),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
 e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
 c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


#: CRC-32 byte by byte, by a table that eight steps of its polynomial give.
OP11 = f"""WITH crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
 d AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents), b AS (SELECT {WORDS} AS w FROM benchmark),
 dw AS MATERIALIZED (SELECT doc_id, unnest(w) AS f FROM d), bw AS MATERIALIZED (SELECT unnest(w) AS f FROM b),
 v AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM dw UNION SELECT f FROM bw)),
 h AS MATERIALIZED (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INTEGER, 2))::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 10000 AS k FROM v, crc),
 s AS (SELECT k, count(*) AS s FROM dw JOIN h USING (f) GROUP BY k), t AS (SELECT k, count(*) AS t FROM bw JOIN h USING (f) GROUP BY k),
 g AS MATERIALIZED (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (k)),
 m AS (SELECT doc_id, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM dw JOIN h USING (f) JOIN g USING (k) GROUP BY doc_id),
 c AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (doc_id)),
 r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM c WHERE n_features >= 20)
SELECT c.*, r.rank FROM c LEFT JOIN r ON c.doc_id = r.doc_id AND r.rank <= (SELECT 10 * count(*) // 100 FROM r)"""

OP12 = r"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
 l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
 f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
  CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) THEN 'C' END, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN w.doc_id > first_id THEN 'E' END) AS fails FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
 n AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
 o AS (SELECT '' AS o UNION ALL SELECT o || x FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x) WHERE NOT contains(o, x)),
 p AS (SELECT o AS filter_order, step, substr(o, step::INTEGER, 1) AS own, substr(o, 1, (step - 1)::INTEGER) AS before FROM o, range(1, 6) s(step) WHERE length(o) = 5),
 j AS (SELECT part, filter_order, step, contains(fails, own) AS fails_own, translate(fails, before, '') <> fails AS gone, fails = own AS only_own, n, good, toxic FROM n, p),
 a AS (SELECT part, filter_order, step, sum(n) FILTER (NOT fails_own AND NOT gone) AS kept, sum(n) FILTER (fails_own AND NOT gone) AS removed, sum(n) FILTER (fails_own AND gone) AS redundant, sum(n) FILTER (only_own) AS unique_fails,
  sum(good) FILTER (fails_own AND NOT gone) AS good_lost, sum(toxic) FILTER (fails_own AND NOT gone) AS toxic_lost FROM j GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
 coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, substr(filter_order, step::INTEGER, 1)), 0)::BIGINT AS shapley FROM a"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1, "op3_chat_format": OP3, "op4_mixing": OP4, "op7_decontaminate": OP7, "op9_near_duplicates": OP9, "op11_importance_resampling": OP11, "op12_filter_audit": OP12}
