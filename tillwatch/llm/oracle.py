"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

URL_FILTER = """
WITH rules(rule_host, rule_path, says) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT r, rule_host || rule_path AS rule, says,
         row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (r)
"""

# Base32 of a SHA-1: 32 groups of five bits, each cut from two neighbouring hexadecimal digits.
WARC = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
kept AS (SELECT html, max(page_id) AS first FROM rows GROUP BY html),
hashed AS (
  SELECT page_id, html, first, list_transform(split(sha1(html) || '0', ''), lambda c: instr('0123456789abcdef', c) - 1) AS d
  FROM rows JOIN kept USING (html))
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((d[5 * i // 4 + 1] * 16 + d[5 * i // 4 + 2]) >> (3 - 5 * i % 4)) & 31)::INTEGER, 1)), 'string_agg', '')
         AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM hashed
"""

NEAR_VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM good UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN parts USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

TOP_PRODUCTS = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

SHINGLE_JOIN = """
WITH RECURSIVE parts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM parts),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.s)
"""

LINE_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT r, pos, line, coalesce(doc_id <> owner, false) AS goes FROM keyed LEFT JOIN shared USING (key)),
sums AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '') AS kept FROM judged GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN sums USING (r)
"""

DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
used AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
mine AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) //
         (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cells),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) //
         (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM cells GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN mine x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN mine y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
over AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM mine JOIN whole USING (lang, term)
  WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

# Costs to go as (cost, letters, text) from the last row to the first, one entry per state: 1 nothing yet,
# 2 after s, 3 after u, 4 after a. Entries compare by cost, then by letters.
TURN_REPAIR = """
WITH RECURSIVE crc AS (
  SELECT *, xor(4294967295, list_reduce(
    list_transform(split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT),
    lambda sum, byte: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
                                  xor(sum, byte)), 4294967295::BIGINT)) % 20 AS hit
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(coalesce(text, ' '), '.', ''), '!', ''), '?', '')
         ELSE coalesce(text, ' ') END AS text, unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial FROM hurt),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS previous, count(*) OVER (PARTITION BY conv_id) AS total
  FROM placed),
suffix AS (
  SELECT conv_id, total + 1 AS n, [
    {c: 0, a: '', t: ''}, {c: 4, a: 'II', t: chr(10) || 'user:' || chr(10) || 'assistant:'},
    {c: 2, a: 'I', t: chr(10) || 'assistant:'}, {c: 0, a: '', t: ''}] AS f
  FROM judged WHERE n = 1
  UNION ALL
  SELECT conv_id, n, list_transform(range(1, 5), lambda s: list_min([
      r[s], {c: 2 + r[[3, 3, 4, 3][s]].c, a: 'I' || r[[3, 3, 4, 3][s]].a,
             t: chr(10) || (CASE s WHEN 3 THEN 'assistant:' ELSE 'user:' END) || r[[3, 3, 4, 3][s]].t},
      {c: 4 + r[[4, 4, 3, 4][s]].c, a: 'II' || r[[4, 4, 3, 4][s]].a,
       t: chr(10) || (CASE s WHEN 3 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END)
          || r[[4, 4, 3, 4][s]].t}]))
  FROM (
    SELECT j.conv_id, j.n, list_transform(range(1, 5), lambda s: list_min([
        {c: 3 + f[s].c, a: 'D' || f[s].a, t: f[s].t},
        CASE WHEN fault IN ('blank', 'duplicate') THEN {c: 1000000, a: '', t: ''}
          WHEN initial = 's' AND s = 1 THEN {c: cut + f[2].c, a: 'K' || f[2].a, t: chr(10) || role || ':' || text || f[2].t}
          WHEN initial = 'u' AND s <> 3 THEN {c: cut + f[3].c, a: 'K' || f[3].a, t: chr(10) || role || ':' || text || f[3].t}
          WHEN initial = 'a' AND s = 3 THEN {c: cut + f[4].c, a: 'K' || f[4].a, t: chr(10) || role || ':' || text || f[4].t}
          ELSE {c: 1000000, a: '', t: ''} END,
        CASE WHEN fault IN ('blank', 'duplicate') THEN {c: 1000000, a: '', t: ''}
          ELSE {c: 2 + cut + f[[3, 3, 4, 3][s]].c, a: 'R' || f[[3, 3, 4, 3][s]].a,
                t: chr(10) || (CASE s WHEN 3 THEN 'assistant' ELSE 'user' END) || ':' || text || f[[3, 3, 4, 3][s]].t} END])) AS r
    FROM suffix x JOIN (SELECT *, (fault IS NOT DISTINCT FROM 'truncated')::INTEGER AS cut FROM judged) j
      ON j.conv_id IS NOT DISTINCT FROM x.conv_id AND j.n = x.n - 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f[1].c, 0)::BIGINT AS cost,
       coalesce(f[1].a, '') AS audit, sha256(coalesce(substr(f[1].t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN suffix x ON x.conv_id IS NOT DISTINCT FROM i.conv_id AND x.n = 1
"""

ORACLE = {
    "op3_shingle_join": SHINGLE_JOIN,
    "op1_url_filter": URL_FILTER, "op4_near_vectors": NEAR_VECTORS, "op5_warc": WARC, "op9_top_products": TOP_PRODUCTS,
    "op11_line_dedup": LINE_DEDUP, "op12_divergence": DIVERGENCE, "op13_turn_repair": TURN_REPAIR}
