"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP10 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size,
         md5('20:' || coalesce(doc_id::varchar, '')) AS h
  FROM documents),
sources AS (SELECT source, sum(size)::bigint AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::int]::bigint AS weight
  FROM sources),
capped AS (SELECT *, (3 * source_size)::bigint AS cap, (3 * source_size)::double / weight AS full_at FROM weighed),
leveled AS (
  SELECT *, row_number() OVER o AS nth,
         ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER b, 0))::double
           / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER b, 0)) AS lv
  FROM capped
  WINDOW o AS (ORDER BY full_at, source NULLS LAST),
         b AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(cap::double, weight * (SELECT arg_min(lv, nth) FROM leveled WHERE lv <= full_at)) AS target
  FROM leveled),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
run AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size
           AS begin_at
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND 2 * begin_at + size <= 2 * rest THEN 1 ELSE 0 END))::bigint AS taken
FROM run
"""


OP7 = r"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::double[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT e.vec_id, coalesce(n.n, 0)::bigint AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = e.vec_id
LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) n ON n.x = e.vec_id
"""

OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                      ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
linked AS (
  SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
links AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, len(s.s)::bigint AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id
"""


OP11 = r"""
WITH ok AS (
  SELECT vec_id, embedding::double[] AS v, row_number() OVER () AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
far AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id,
         sqrt(list_reduce(list_prepend(0::double, list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                          lambda a, x: a + x)) AS score
  FROM ok q JOIN ok c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score, vec_id) AS rank FROM far)
SELECT query_id, rank::int AS rank, vec_id, score FROM near WHERE rank <= 10
"""

OP12 = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nth
  FROM conversations WHERE conv_id IS NOT NULL),
stored AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY nth) AS seq FROM turns GROUP BY conv_id),
digits(conv_id, rest, crc) AS (
  SELECT conv_id, conv_id::varchar, 4294967295::bigint FROM stored
  UNION ALL
  SELECT conv_id, rest[2:],
         list_reduce(list_prepend(xor(crc, ascii(rest[1])::bigint), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                     lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END)
  FROM digits WHERE rest <> ''),
heads AS (SELECT conv_id, xor(crc, 4294967295::bigint) % 4 AS h FROM digits WHERE rest = ''),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.seq[1:h], []), s.seq[h + 1:]) AS seq
  FROM stored s JOIN heads USING (conv_id) LEFT JOIN stored b ON b.conv_id = s.conv_id - s.conv_id % 20),
paths AS (SELECT conv_id, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS depth, seq FROM rebuilt),
members AS (SELECT conv_id, n, depth, seq[1:depth] AS prefix FROM paths),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS rep, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
         len(regexp_extract_all(coalesce(prefix[depth].text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM members GROUP BY depth, prefix),
linked AS (
  SELECT c.*, p.rep AS parent FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.prefix[1:c.depth - 1]),
counted AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children
  FROM linked l LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL) k
    ON k.parent = l.rep AND k.depth = l.depth),
below AS (
  SELECT a.rep, a.depth, sum((b.n_children = 0)::int) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
  FROM counted a JOIN members m ON m.depth = a.depth AND m.prefix = a.prefix
       JOIN counted b ON b.rep = m.conv_id AND b.depth >= a.depth
  GROUP BY a.rep, a.depth)
SELECT c.rep AS conv_id, c.depth::bigint AS depth, c.parent AS parent_conv_id, c.n_convs::bigint AS n_convs,
       c.n_children::bigint AS n_children, b.n_leaves::bigint AS n_leaves, b.saved::bigint AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.rep = c.rep AND b.depth = c.depth
"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
sized AS (SELECT r, doc_id, t, len(t)::bigint AS n FROM docs WHERE len(t) > 0),
corpus AS (SELECT count(*)::bigint AS n_docs, sum(n)::bigint AS n_terms FROM sized),
tf AS (SELECT r, term, count(*)::bigint AS tf FROM (SELECT r, unnest(t) AS term FROM sized) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint AS w
  FROM tf, corpus GROUP BY term),
items AS (
  SELECT item_id, row_number() OVER () AS i,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
needs AS (SELECT i, any_value(item_id) AS item_id, term, count(*)::bigint AS times FROM items GROUP BY i, term),
scored AS (
  SELECT needs.i, any_value(needs.item_id) AS item_id, s.r, any_value(s.doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * s.n * n_docs) // n_terms))))::bigint AS score
  FROM needs JOIN weights USING (term) JOIN tf USING (term) JOIN sized s ON s.r = tf.r, corpus
  GROUP BY needs.i, s.r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank::int AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP5 = r"""
WITH crcs AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(
           list_prepend(n::bigint, [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END)) AS t),
texts AS (SELECT doc_id, row_number() OVER () AS row, encode(coalesce(text, '')) AS b FROM documents),
digits AS (SELECT doc_id, row, octet_length(b) AS n, hex(b) AS h FROM texts),
sized AS (
  SELECT doc_id, row, n + 16 AS size,
         xor(4294967295::bigint, list_reduce(
           list_prepend(4294967295::bigint, list_transform(range(0, n), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::bigint)),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc
  FROM digits, crcs),
axis AS (
  SELECT *, row_number() OVER o - 1 AS rank, sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER () AS all_bytes
  FROM sized WINDOW o AS (ORDER BY doc_id NULLS FIRST, crc, size, row)),
placed AS (SELECT *, ((2 * upto - size) * 40 // (2 * all_bytes))::int AS shard FROM axis)
SELECT doc_id, size::bigint AS size, crc AS text_crc32, 'bytes' AS law, shard,
       (rank - min(rank) OVER (PARTITION BY shard))::bigint AS slot, NULL::int AS grown_shard
FROM placed
"""


def all_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": OP1, "op5_prefix_sharding": OP5, "op7_pca_tiles": OP7, "op10_source_mixing": OP10, "op11_curve_search": OP11,
            "op12_prefix_trie": OP12, "op13_lexical_search": OP13}
