"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op9_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS} AS w FROM benchmark),
bl AS (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bl)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT u, s, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT u, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT u, s, dw.n, item FROM dw JOIN win ON dw.x = win.x AND dw.n = win.n),
cover AS (SELECT u, count(DISTINCT p) AS n_hit FROM (SELECT u, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT u, s, n FROM hit)) GROUP BY u),
its AS (SELECT u, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT u, item FROM hit) GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (u) LEFT JOIN its USING (u)
"""

ORACLES["op4_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s0),
s2 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][i % 3 + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM s1),
s3 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS before, sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s2),
s4 AS (SELECT *, cap <= w * (budget - before) / rest AS is_full FROM s3),
s5 AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0.0::DOUBLE END) OVER () AS used, sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE w END) OVER () AS free FROM s4),
s6 AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * (budget - used) / free END AS target FROM s5),
s AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM s6),
g AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS base FROM g),
x AS (SELECT c.source, c.h, c.base + c.n / 2.0::DOUBLE <= s.target - s.rounds * s.source_size AS more FROM c JOIN s ON c.source IS NOT DISTINCT FROM s.source)
SELECT d.doc_id, d.size, s.source_size, s.target, CAST(d.size * least(2, s.rounds + CASE WHEN x.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""

BASE32 = "array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(x, CAST(g * 5 + 1 AS INTEGER), 5) AS BIGINT) >> b) & 31 AS INTEGER) + 1, 1)), '')), '')"

ORACLES["op10_warc"] = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id FROM p)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

# The pages state no canonical link and no redirect; classes of aliases are tested against brute force.
ORACLES["op2_url_filters"] = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages),
h AS (SELECT page_id, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(regexp_replace(x, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fit AS (SELECT DISTINCT host, path, rhost || rpath AS rule, verdict FROM (SELECT DISTINCT host, path FROM h), rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
best AS (SELECT host, path, rule, verdict FROM fit QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule) = 1)
SELECT page_id, h.host, h.path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN best ON h.host = best.host AND h.path = best.path
"""

# The conversations hold no tool calls; those are tested against brute force.
ORACLES["op7_chat"] = r"""
SELECT conv_id, turn AS at, CAST(0 AS BIGINT) AS level, turn, CAST(-1 AS BIGINT) AS seq, 'message' AS kind, CAST(NULL AS VARCHAR) AS call_id, 'ok' AS status, '' AS errors,
'{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS json FROM conversations
"""
