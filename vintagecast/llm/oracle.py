"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
k AS (  -- the sources clamped before this one, were they clamped in the order of cap / weight
  SELECT *, 3 * source_size AS cap,
    sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
    coalesce(sum(3 * source_size) OVER p, 0) AS c, coalesce(sum(w) OVER p, 0) AS cw
  FROM s WINDOW p AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min_by((total - c) / (ws - cw), c) AS level FROM k WHERE cap * (ws - cw) > (total - c) * w),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * w) AS target FROM k, l),
r AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, target - whole * source_size AS want,
    CAST(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM r)
SELECT doc_id, size, source_size, target,
  CASE WHEN size > 0 THEN least(3, whole + CASE WHEN want > 0 AND upto - size / 2 <= want THEN 1 ELSE 0 END) * size ELSE 0 END AS taken
FROM p
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS seen FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT doc_id, min(seen) AS component FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>', '\0.', 'g')) AS n,
    length(regexp_replace(replace(role, '\', '\\'), '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>', '\0.', 'g')) AS nr
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE role WHEN 'user' THEN 18 + n WHEN 'assistant' THEN 7 + n ELSE 22 + nr + n END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM g),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
m AS (SELECT r, i, p.n, item FROM p JOIN win ON p.n = win.n AND array_to_string(p.w[i : i + p.n - 1], ' ') = win.s),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS k FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

OP12 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

OP13 = r"""
WITH w AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
o AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, w[i : i + k - 1] AS ws
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, any_value(ws) AS ws, count(*) AS f FROM o GROUP BY lang, k, phrase),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS len, phrase, ws, f AS a, unnest(range(1, k)) AS k FROM f WHERE k > 1 AND f >= 10),
x AS (
  SELECT c.*, l.f AS l, r.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.k = c.k AND l.phrase = array_to_string(c.ws[1 : c.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.k = c.len - c.k AND r.phrase = array_to_string(c.ws[c.k + 1 : c.len], ' ')),
m AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, len, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS part FROM m WHERE len = 3)
  GROUP BY lang, part),
z AS (SELECT m.* FROM m LEFT JOIN i ON i.lang = m.lang AND m.len = 2 AND i.part = m.phrase WHERE i.a IS NULL OR 100 * i.a < 50 * m.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM z JOIN t USING (lang) QUALIFY rank <= 2000
"""

SQL = {"op11_decontaminate": OP11, "op12_hard_negatives": OP12, "op13_collocations": OP13, "op10_format_chat": OP10, "op4_jaccard_join": OP4, "op2_mix_sources": OP2, "op5_exact_dedup": OP5}
