"""DuckDB SQL of the queries in ``queries``."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"

OP9 = rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, {SPACED}), []) AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""

OP2 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP3 = rf"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, {ALNUM}), []) AS w FROM documents),
items AS (SELECT item_id, coalesce(regexp_extract_all({LOWER}, {ALNUM}), []) AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
runs AS (SELECT DISTINCT n FROM wins),
hits AS (SELECT doc_id, i, runs.n, item_id FROM words, runs, unnest(range(1, len(w) - runs.n + 2)) AS t(i)
  JOIN wins ON wins.n = runs.n AND wins.k = array_to_string(w[i:i + runs.n - 1], ' ')),
counts AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(range(0, n)) AS t(o) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN counts USING (doc_id) LEFT JOIN names USING (doc_id)
"""

OP5 = """
WITH lines AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line, len(string_split(text, chr(10))) AS n
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i) WHERE text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
rolled AS (SELECT *, h + 31 * lag(h, 1, 0) OVER w AS back, lead(h, 1, 0) OVER w + 31 * lead(h, 2, 0) OVER w AS ahead FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cut AS (SELECT doc_id, i, line, c, ((CASE WHEN c % 2 = 0 THEN back ELSE ahead END) >> (c // 2)::BIGINT) & 1 AS bit FROM rolled, range(12) AS x(c)),
placed AS (SELECT *, coalesce(sum(1 - bit) OVER (PARTITION BY doc_id, c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM cut),
all_chunks AS (SELECT doc_id, c, min(i) AS start, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS chunk FROM placed GROUP BY doc_id, c, g),
chunks AS (SELECT DISTINCT doc_id, start, lines, chunk FROM all_chunks WHERE lines >= 2),
judged AS (SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY doc_id, start) > 1),
gone AS (SELECT DISTINCT doc_id, start + o AS i FROM judged, unnest(range(0, lines)) AS t(o)),
left_over AS (SELECT l.doc_id, count(g.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(kept) AS kept_sha256
FROM documents LEFT JOIN left_over USING (doc_id)
"""

OP6 = rf"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {SPACED})), 0) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source),
ratio AS (SELECT *, 3.0::DOUBLE * source_size / w AS r, sum(source_size) OVER () AS budget FROM sources),
levels AS (SELECT *, ((budget - coalesce(sum(3 * source_size) OVER (ORDER BY r, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(w) OVER (ORDER BY r, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS v FROM ratio),
level AS (SELECT max(v) AS v FROM levels WHERE v <= r),
targets AS (SELECT source, source_size, w, least(w * v, 3.0::DOUBLE * source_size) AS target FROM sources, level),
queues AS (SELECT doc_id, s.source, size, source_size, w, target,
  sum(size) OVER (PARTITION BY s.source ORDER BY md5('6:' || doc_id::VARCHAR), doc_id) AS upto FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (SELECT *, (upto + e * source_size)::DOUBLE / w AS finish FROM queues, range(3) AS x(e)),
spent AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, e, doc_id::VARCHAR ROWS UNBOUNDED PRECEDING) AS spent, (SELECT sum(size) FROM sized) AS budget FROM turns)
SELECT doc_id, size, source_size, target, sum(CASE WHEN spent <= budget THEN size ELSE 0 END)::BIGINT AS taken FROM spent GROUP BY ALL
"""

OP7 = rf"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, {SPACED}), []) AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM words, unnest(range(1, greatest(len(w) - 11, 1))) AS t(i)),
least AS (SELECT k, min(doc_id) AS first FROM wins GROUP BY k),
hits AS (SELECT DISTINCT doc_id, i + o AS p FROM wins JOIN least USING (k), unnest(range(0, 13)) AS t(o) WHERE first < doc_id),
gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hits GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

OP12 = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op2_norm_buckets": OP2, "op3_decontaminate": OP3, "op5_line_chunks": OP5, "op6_mixing": OP6, "op7_block_anchors": OP7, "op9_ngram_join": OP9, "op12_four_russians": OP12}
