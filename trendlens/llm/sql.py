"""DuckDB SQL of the queries that SQL can express."""

OP1 = r"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'none' ELSE 'host ' || source END AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
hits AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM l
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(lines.n, 0) AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeat, 10 * n_symbols > n_words AS symbols,
             2 * n_dup_lines > n_lines AS dup_lines, word_chars < 2 * n_words OR word_chars > 15 * n_words AS word_length FROM m),
u AS (SELECT host, rule, count(*) AS n, count(*) FILTER (WHERE failed) AS f
      FROM (UNPIVOT (SELECT host, short, repeat, symbols, dup_lines, word_length FROM f)
            ON short, repeat, symbols, dup_lines, word_length INTO NAME rule VALUE failed) GROUP BY ALL),
p AS (SELECT rule, sum(f) / sum(n)::DOUBLE AS m, sum(n)::DOUBLE AS total, count(*) AS hosts,
             sum(n * (f / n::DOUBLE) * (f / n::DOUBLE)) AS sq FROM u GROUP BY rule),
v AS (SELECT rule, m, sq / total - m * m - m * (1 - m) * (hosts - 1) / total AS var FROM p),
k AS (SELECT rule, m, CASE WHEN var > 0 THEN greatest(2.0, least(10000.0, m * (1 - m) / var - 1)) ELSE 10000.0 END AS weight FROM v),
post AS (SELECT host, f + m * weight AS a, n - f + (1 - m) * weight AS b FROM u JOIN k USING (rule)),
blocked AS (SELECT DISTINCT host FROM post
            WHERE a / (a + b) - 3.0 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeat AS base_failed,
       host IN (SELECT host FROM blocked) AS host_blocked,
       NOT (short OR repeat OR symbols OR dup_lines OR word_length) AND host NOT IN (SELECT host FROM blocked) AS kept
FROM f
"""

OP8 = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest, url FROM pages),
u AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(action, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('allow', 'example.org', '/en/1'),
                             ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action
        FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
h AS (SELECT host, string_split(host, '.')[-1] AS suffix, regexp_extract(host, '([^.]*\.)?[^.]*$', 0) AS domain, count(*) AS n,
             count(*) FILTER (WHERE quality = 0 OR toxic = 1) AS bad
      FROM u JOIN labels ON labels.doc_id = page_id WHERE quality = 0 OR toxic = 1 OR (quality IS NOT NULL AND toxic IS NOT NULL)
      GROUP BY host),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
w AS (SELECT level, key, total, m, sq / total - m * m - m * (1 - m) * (members - 1) / total AS var FROM (
        SELECT 'root' AS level, '' AS key, sum(n)::DOUBLE AS total, sum(bad) / sum(n)::DOUBLE AS m, count(*) AS members, sum(bad * bad / n::DOUBLE) AS sq FROM s
        UNION ALL SELECT 'suffix', suffix, sum(n)::DOUBLE, sum(bad) / sum(n)::DOUBLE, count(*), sum(bad * bad / n::DOUBLE) FROM d GROUP BY suffix
        UNION ALL SELECT 'domain', domain, sum(n)::DOUBLE, sum(bad) / sum(n)::DOUBLE, count(*), sum(bad * bad / n::DOUBLE) FROM h GROUP BY domain)),
k AS (SELECT level, key, m, CASE WHEN var > 0 THEN greatest(1.0, least(1000.0, m * (1 - m) / var - 1)) ELSE 1000.0 END AS w FROM w),
s1 AS (SELECT suffix, (bad + k.m * k.w) / (n + k.w) AS mean FROM s, k WHERE k.level = 'root'),
d1 AS (SELECT domain, (bad + s1.mean * k.w) / (n + k.w) AS mean FROM d JOIN s1 USING (suffix) JOIN k ON k.level = 'suffix' AND k.key = d.suffix),
h1 AS (SELECT host, n, k.w, (bad + d1.mean * k.w) / (n + k.w) AS mean FROM h JOIN d1 USING (domain) JOIN k ON k.level = 'domain' AND k.key = h.domain),
blocked AS (SELECT host FROM h1 WHERE mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)) > 0.2)
SELECT u.page_id, host, path, rule, coalesce(action, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict,
       host IN (SELECT host FROM blocked) AS host_blocked
FROM u LEFT JOIN fit USING (page_id)
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hits AS (SELECT r, i, k, words FROM dw WHERE words IN (SELECT words FROM win)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT r, item_id FROM hits JOIN win USING (words)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(v.n, 0) AS lang_n, coalesce(total, 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS count, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (kept.n + 2)) // (g.lang_n + 2 * g.v)::HUGEINT AS q
      FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE count > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS length FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, docs),
m AS (SELECT r, doc_id, 50 + (50 * len(w) * docs) // greatest(length, 1) AS m FROM d, c),
s AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 50
"""
