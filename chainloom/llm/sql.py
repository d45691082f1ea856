"""DuckDB SQL of the queries that SQL can express, by brute force."""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda w: w <> '')"""

WARC_RECORDS = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, payload, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM h"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 75 * (x.n + y.n - both_)),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, d.b FROM r JOIN d ON d.a = r.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""

TOP_BY_BM25 = f"""
WITH t AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM t GROUP BY 1, 2),
dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY 1),
st AS (SELECT count(*) AS n, (SELECT sum(tf) FROM tf) / count(*) AS avg FROM documents),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.tf * ln(1 + (n - df + 5e-1) / (df + 5e-1)) * d.tf * 22e-1 / (d.tf + 12e-1 * (25e-2 + 75e-2 * dl / avg))), 9) AS score
  FROM tf q JOIN tf d ON d.w = q.w JOIN df ON df.w = q.w JOIN dl ON dl.doc_id = d.doc_id, st WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM rk WHERE rank <= 10"""

COLLOCATIONS = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\n\v\f\r]')) AS t FROM d),
w AS (SELECT lang, list_filter(string_split_regex(t, '[ \t]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM w, (VALUES (1), (2), (3)) s(k)),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
x AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS first_, array_to_string(w[j + 1:k], ' ') AS rest_ FROM c, (VALUES (1), (2)) v(j) WHERE j < k),
s AS (SELECT x.lang, x.k, x.g, x.a, j, l.a AS l, r.a AS r, CAST((CAST(1000000 AS HUGEINT) * x.a * x.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.g = first_ JOIN f r ON r.lang = x.lang AND r.g = rest_),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS cut_no FROM s),
o AS (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM c WHERE k = 3),
y AS (SELECT lang, g, max(a) AS longer FROM o GROUP BY 1, 2),
z AS (SELECT b.* FROM b LEFT JOIN y USING (lang, g) WHERE cut_no = 1 AND (b.k > 2 OR longer IS NULL OR 100 * longer < 50 * b.a)),
q AS (SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score FROM z JOIN n ON n.lang = z.lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM q WHERE rank <= 2000"""

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f,
  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM w),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY 1, 2),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
j AS (SELECT part, o, step, o[step] AS x, n, good, toxic, f, len(list_filter(o[1:step - 1], lambda y: f[y])) > 0 AS gone, len(list_filter(f, lambda y: y)) AS failed FROM c, s),
r AS (SELECT part, o, step, x, sum(n) FILTER (WHERE NOT gone AND NOT f[x]) AS kept, sum(n) FILTER (WHERE NOT gone AND f[x]) AS removed, sum(n) FILTER (WHERE gone AND f[x]) AS redundant,
  sum(n) FILTER (WHERE f[x] AND failed = 1) AS unique_fails, sum(good) FILTER (WHERE NOT gone AND f[x]) AS good_lost, sum(toxic) FILTER (WHERE NOT gone AND f[x]) AS toxic_lost FROM j GROUP BY 1, 2, 3, 4),
h AS (SELECT part, x, sum(removed) AS shapley FROM r GROUP BY 1, 2)
SELECT r.part, array_to_string(list_transform(o, lambda y: 'ABCDE'[y]), '') AS filter_order, CAST(step AS INTEGER) AS step, 'ABCDE'[r.x] AS filter, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM r JOIN h ON h.part = r.part AND h.x = r.x"""
