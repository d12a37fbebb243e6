"""Reference SQL (DuckDB dialect) for every registered job.

Written independently of the Spark plans: itemsets are counted by expanding
each basket's sorted item list into index combinations (``generate_series``
+ ``unnest``), supports are looked up by string keys, and the similarity
jobs recompute shingles, signatures and bands with list functions. The
views ``lineitem part events documents labels ...`` are assumed registered.
"""

from __future__ import annotations

from tessera.functions.hashing import MINHASH_PRIME, MINHASH_RANGE, SHINGLE_PRIME, shingle_weights
from tessera.plans import registry as reg

ORDER_BRAND = """SELECT DISTINCT l.l_orderkey AS basket, p.p_brand AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey IS NOT NULL AND p.p_brand IS NOT NULL"""

ORDER_BRAND_TYPE = """SELECT DISTINCT l.l_orderkey AS basket, concat_ws('|', p.p_brand, p.p_type) AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey IS NOT NULL"""

USER_K = """SELECT DISTINCT user_id AS basket, json_extract_string(props, '$.k') AS item
  FROM events WHERE user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL"""

CUSTOMER_BRAND = """SELECT DISTINCT o.o_custkey AS basket, p.p_brand AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_custkey IS NOT NULL AND p.p_brand IS NOT NULL"""

DICTIONARY = """SELECT p_brand AS item, min(p_name) AS description FROM part
  WHERE p_brand IS NOT NULL GROUP BY p_brand"""


def _levels(baskets_sql: str, frac: float) -> str:
    """CTEs b, thr, f1, bl, e2, f2, e3, f3 (k = 1..3 by list expansion)."""
    return f"""
b AS ({baskets_sql}),
thr AS (SELECT ceil({frac}::DOUBLE * count(DISTINCT basket)) AS s,
               count(DISTINCT basket) AS n FROM b),
f1 AS (SELECT item, count(*) AS support FROM b GROUP BY item
       HAVING count(*) >= (SELECT s FROM thr)),
bl AS (SELECT basket, list_sort(list(item)) AS items FROM b
       WHERE item IN (SELECT item FROM f1) GROUP BY basket),
e1 AS (SELECT basket, items, unnest(generate_series(1, len(items))) AS i FROM bl),
e2 AS (SELECT basket, items, i, unnest(generate_series(i + 1, len(items))) AS j FROM e1),
f2 AS (SELECT items[i] AS item_1, items[j] AS item_2, count(*) AS support FROM e2
       GROUP BY 1, 2 HAVING count(*) >= (SELECT s FROM thr)),
e3 AS (SELECT items[i] AS a, items[j] AS b2, items[k] AS c FROM
        (SELECT items, i, j, unnest(generate_series(j + 1, len(items))) AS k FROM e2)),
f3 AS (SELECT a AS item_1, b2 AS item_2, c AS item_3, count(*) AS support FROM e3
       WHERE EXISTS (SELECT 1 FROM f2 WHERE f2.item_1 = a AND f2.item_2 = b2)
         AND EXISTS (SELECT 1 FROM f2 WHERE f2.item_1 = a AND f2.item_2 = c)
         AND EXISTS (SELECT 1 FROM f2 WHERE f2.item_1 = b2 AND f2.item_2 = c)
       GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT s FROM thr))"""


def _rules(baskets_sql: str, frac: float) -> str:
    """Adds CTEs sup, r2, r3, cnt2, cnt3, met (all rules with metrics)."""
    return _levels(baskets_sql, frac) + """,
sup AS (SELECT item AS k, support FROM f1
        UNION ALL SELECT item_1 || ',' || item_2, support FROM f2),
r2 AS (SELECT item_2 AS lhs, item_1 AS rhs, support AS rule_count FROM f2
       UNION ALL SELECT item_1, item_2, support FROM f2),
r3 AS (SELECT item_2 || ',' || item_3 AS lhs, item_1 AS rhs, support AS rule_count FROM f3
       UNION ALL SELECT item_1 || ',' || item_3, item_2, support FROM f3
       UNION ALL SELECT item_1 || ',' || item_2, item_3, support FROM f3),
cnt2 AS (SELECT r.lhs, r.rhs, r.rule_count, s.support AS lhs_count, f.support AS rhs_count
         FROM r2 r JOIN sup s ON s.k = r.lhs JOIN f1 f ON f.item = r.rhs),
cnt3 AS (SELECT r.lhs, r.rhs, r.rule_count, s.support AS lhs_count, f.support AS rhs_count
         FROM r3 r JOIN sup s ON s.k = r.lhs JOIN f1 f ON f.item = r.rhs),
mx AS (SELECT lhs, rhs, rule_count, lhs_count, rhs_count,
              rule_count::DOUBLE AS c, lhs_count::DOUBLE AS l, rhs_count::DOUBLE AS h,
              (SELECT n::DOUBLE FROM thr) AS nn
       FROM (SELECT * FROM cnt2 UNION ALL SELECT * FROM cnt3)),
my AS (SELECT *, c / l AS confidence FROM mx),
mz AS (SELECT *, confidence - h / nn AS interest, nn * confidence / h AS lift,
              greatest(lhs_count + rhs_count - (SELECT n FROM thr), 1) AS lo,
              least(lhs_count, rhs_count) AS hi FROM my),
met AS (SELECT lhs, rhs, rule_count, lhs_count, rhs_count, confidence, interest, lift,
               CASE WHEN hi = lo THEN NULL ELSE (rule_count - lo)::DOUBLE / (hi - lo)::DOUBLE END AS std_lift
        FROM mz)"""


OB = reg.ORDER_BRAND_SUPPORT
UK = reg.USER_K_SUPPORT
CB = reg.CUSTOMER_BRAND_SUPPORT


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def market_basket_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["item_dictionary"] = DICTIONARY
    q["basket_distinct"] = ORDER_BRAND
    q["basket_count"] = f"SELECT count(DISTINCT basket) AS n_baskets FROM ({ORDER_BRAND})"
    q["frequent_items"] = _with(_levels(ORDER_BRAND, OB), "SELECT item, support FROM f1")
    q["materialize"] = q["frequent_items"]
    prune = _levels(ORDER_BRAND_TYPE, reg.PRUNE_SUPPORT)
    q["prune_infrequent"] = _with(prune, "SELECT basket, item FROM b WHERE item IN (SELECT item FROM f1)")
    q["basket_itemlists"] = _with(prune, "SELECT basket, array_to_string(items, ';') AS items FROM bl")
    q["frequent_pairs"] = _with(_levels(ORDER_BRAND, OB), "SELECT item_1, item_2, support FROM f2")
    q["candidate_triples"] = _with(_levels(ORDER_BRAND, OB), """
SELECT x.item_1, x.item_2, y.item_2 AS item_3
FROM f2 x JOIN f2 y ON x.item_1 = y.item_1 AND x.item_2 < y.item_2
WHERE EXISTS (SELECT 1 FROM f2 z WHERE z.item_1 = x.item_2 AND z.item_2 = y.item_2)""")
    q["frequent_triples"] = _with(_levels(ORDER_BRAND, OB), "SELECT item_1, item_2, item_3, support FROM f3")
    q["frequent_pairs_user_k"] = _with(_levels(USER_K, UK), "SELECT item_1, item_2, support FROM f2")
    q["frequent_triples_user_k"] = _with(_levels(USER_K, UK),
                                         "SELECT item_1, item_2, item_3, support FROM f3")
    customers = _levels(CUSTOMER_BRAND, CB)
    q["frequent_pairs_customer_brand"] = _with(customers, "SELECT item_1, item_2, support FROM f2")
    q["candidate_triples_customer_brand"] = _with(customers, """
SELECT x.item_1, x.item_2, y.item_2 AS item_3
FROM f2 x JOIN f2 y ON x.item_1 = y.item_1 AND x.item_2 < y.item_2
WHERE EXISTS (SELECT 1 FROM f2 z WHERE z.item_1 = x.item_2 AND z.item_2 = y.item_2)""")
    q["frequent_triples_customer_brand"] = _with(customers, "SELECT item_1, item_2, item_3, support FROM f3")
    q["association_rules_customer_brand"] = _with(_rules(CUSTOMER_BRAND, CB), "SELECT * FROM met WHERE std_lift >= 0")
    q["itemset_counts"] = _with(_levels(ORDER_BRAND, OB), """
SELECT 1 AS k, count(*) AS n_itemsets FROM f1
UNION ALL SELECT 2, count(*) FROM f2
UNION ALL SELECT 3, count(*) FROM f3""")
    q["top_pairs"] = _with(_levels(ORDER_BRAND, OB) + f",\nd AS ({DICTIONARY})", f"""
SELECT row_number() OVER (ORDER BY t.support DESC, t.item_1, t.item_2) AS rank,
       t.item_1, t.item_2, d1.description AS description_1, d2.description AS description_2, t.support
FROM (SELECT * FROM f2 ORDER BY support DESC, item_1, item_2 LIMIT {reg.TOP_N}) t
LEFT JOIN d d1 ON d1.item = t.item_1 LEFT JOIN d d2 ON d2.item = t.item_2""")
    q["top_triples"] = _with(_levels(ORDER_BRAND, OB) + f",\nd AS ({DICTIONARY})", f"""
SELECT row_number() OVER (ORDER BY t.support DESC, t.item_1, t.item_2, t.item_3) AS rank,
       t.item_1, t.item_2, t.item_3, d1.description AS description_1,
       d2.description AS description_2, d3.description AS description_3, t.support
FROM (SELECT * FROM f3 ORDER BY support DESC, item_1, item_2, item_3 LIMIT {reg.TOP_N}) t
LEFT JOIN d d1 ON d1.item = t.item_1 LEFT JOIN d d2 ON d2.item = t.item_2
LEFT JOIN d d3 ON d3.item = t.item_3""")
    q["label_itemsets"] = _with(_levels(ORDER_BRAND, OB) + f",\nd AS ({DICTIONARY})", """
SELECT t.item_1, t.item_2, t.support, d1.description AS description_1, d2.description AS description_2
FROM f2 t LEFT JOIN d d1 ON d1.item = t.item_1 LEFT JOIN d d2 ON d2.item = t.item_2""")
    rules = _rules(ORDER_BRAND, OB)
    q["rule_generation"] = _with(rules, "SELECT lhs, rhs, rule_count FROM r2 UNION ALL "
                                        "SELECT lhs, rhs, rule_count FROM r3")
    q["rules_pairs"] = _with(rules, "SELECT * FROM cnt2")
    q["rules_triples"] = _with(rules, "SELECT * FROM cnt3")
    q["rule_metrics"] = _with(rules, "SELECT * FROM met")
    q["association_rules"] = _with(rules, f"SELECT * FROM met WHERE std_lift >= {reg.MIN_STD_LIFT}")
    q["association_rules_user_k"] = _with(_rules(USER_K, UK),
                                          f"SELECT * FROM met WHERE std_lift >= {reg.MIN_STD_LIFT}")
    q["rule_lines"] = _with(rules + f",\nd AS ({DICTIONARY})", f"""
SELECT '{{' || concat_ws(', ', coalesce(d1.description, split_part(m.lhs, ',', 1)),
         coalesce(d2.description, nullif(split_part(m.lhs, ',', 2), ''))) || '}} -> {{' || coalesce(dr.description, m.rhs) || '}}: '
       || printf('%.6f', m.std_lift) || ', ' || printf('%.6f', m.lift) || ', '
       || printf('%.6f', m.confidence) || ', ' || printf('%.6f', m.interest) AS line
FROM met m
LEFT JOIN d d1 ON d1.item = split_part(m.lhs, ',', 1)
LEFT JOIN d d2 ON d2.item = nullif(split_part(m.lhs, ',', 2), '')
LEFT JOIN d dr ON dr.item = m.rhs
WHERE m.std_lift >= {reg.MIN_STD_LIFT}""")
    q["text_sink"] = f"SELECT row_number() OVER (ORDER BY line DESC) AS rank, line FROM ({q['rule_lines']})"
    q["parquet_sink"] = ("SELECT row_number() OVER (ORDER BY support DESC, item_1, item_2) AS rank, item_1, item_2, support "
                         f"FROM ({q['frequent_pairs']})")
    q["top_pairs_tsv"] = ("SELECT '[''' || coalesce(description_1, item_1) || ''', ''' || coalesce(description_2, item_2) || ''']' "
                          f"AS pair, support AS count FROM ({q['top_pairs']})")
    q["csv_scan"] = "SELECT event_id, user_id, event_type, value, props FROM events"
    q["json_scan"] = "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents"
    return q


def _similarity_ctes(p: reg.LshParams = reg.LSH) -> str:
    """CTEs d, chars, win, sh, sizes, params, mh, bands, cand, inter, psim."""
    k, t = p.shingle_size, p.threshold
    weights = shingle_weights(k)
    poly = " + ".join(["c * %d" % weights[0]]
                      + ["lead(c, %d) OVER w * %d" % (j, weights[j]) for j in range(1, k)])
    values = ", ".join("(%d, %d, %d)" % (i, a, b) for i, (a, b) in enumerate(p.hash_params()))
    return f"""
d AS (SELECT doc_id, text FROM documents
      WHERE doc_id IS NOT NULL AND text IS NOT NULL AND length(text) >= {k}),
chars AS (SELECT doc_id, unicode(unnest(string_split(text, '')))::BIGINT AS c,
                 generate_subscripts(string_split(text, ''), 1) AS pos FROM d),
win AS (SELECT doc_id, {poly} AS v FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
sh AS (SELECT DISTINCT doc_id, v % {SHINGLE_PRIME} AS shingle FROM win WHERE v IS NOT NULL),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
params AS (SELECT * FROM (VALUES {values}) t(fn, a, b)),
mh AS (SELECT s.doc_id, p.fn, min(((p.a * s.shingle + p.b) % {MINHASH_PRIME}) % {MINHASH_RANGE}) AS v
       FROM sh s CROSS JOIN params p GROUP BY s.doc_id, p.fn),
bands AS (SELECT doc_id, fn // {p.rows} AS band, string_agg(v::VARCHAR, ',' ORDER BY fn) AS band_rows
          FROM mh GROUP BY doc_id, fn // {p.rows}),
cand AS (SELECT DISTINCT a.doc_id AS first, b.doc_id AS second FROM bands a JOIN bands b
         ON a.band = b.band AND a.band_rows = b.band_rows AND a.doc_id < b.doc_id),
inter AS (SELECT c.first, c.second, count(s2.shingle) AS common
          FROM cand c JOIN sh s1 ON s1.doc_id = c.first
          LEFT JOIN sh s2 ON s2.doc_id = c.second AND s2.shingle = s1.shingle
          GROUP BY c.first, c.second),
psim AS (SELECT i.first, i.second,
                i.common::DOUBLE / (n1.n + n2.n - i.common)::DOUBLE AS similarity
         FROM inter i JOIN sizes n1 ON n1.doc_id = i.first JOIN sizes n2 ON n2.doc_id = i.second),
simp AS (SELECT * FROM psim WHERE similarity >= {t})"""


def _quality_ctes(p: reg.LshParams = reg.LSH, fraction: float = reg.FPFN_FRACTION,
                  n_rounds: int = reg.FPFN_ROUNDS) -> str:
    """CTEs rounds, samp, spairs, sjac, fp, fn on top of the similarity CTEs."""
    t = p.threshold
    seed = p.seed
    return _similarity_ctes(p) + f""",
rounds AS (SELECT range::INTEGER AS round FROM range(0, {n_rounds})),
samp AS (SELECT r.round, d.doc_id FROM d CROSS JOIN rounds r
         WHERE ('0x' || substr(md5(d.doc_id::VARCHAR || ':' || ({seed} + r.round)::VARCHAR), 1, 8))::BIGINT
               / 4294967296.0 < {fraction}),
spairs AS (SELECT s1.round, s1.doc_id AS first, s2.doc_id AS second
           FROM samp s1 JOIN samp s2 ON s1.round = s2.round AND s1.doc_id < s2.doc_id),
sinter AS (SELECT p.round, p.first, p.second, count(b.shingle) AS common
           FROM spairs p JOIN sh a ON a.doc_id = p.first
           LEFT JOIN sh b ON b.doc_id = p.second AND b.shingle = a.shingle
           GROUP BY p.round, p.first, p.second),
sjac AS (SELECT i.round, i.first, i.second,
                i.common::DOUBLE / (n1.n + n2.n - i.common)::DOUBLE AS similarity,
                c.first IS NOT NULL AS is_candidate
         FROM sinter i JOIN sizes n1 ON n1.doc_id = i.first JOIN sizes n2 ON n2.doc_id = i.second
         LEFT JOIN cand c ON c.first = i.first AND c.second = i.second),
fnp AS (SELECT round, first, second, similarity FROM sjac
        WHERE NOT is_candidate AND similarity >= {t}),
per AS (SELECT r.round,
               (SELECT count(*) FROM samp s WHERE s.round = r.round) AS n_docs,
               (SELECT count(*) FROM sjac j WHERE j.round = r.round AND j.is_candidate) AS candidates,
               (SELECT count(*) FROM sjac j WHERE j.round = r.round AND j.is_candidate
                                              AND j.similarity >= {t}) AS verified,
               (SELECT count(*) FROM fnp f WHERE f.round = r.round) AS false_negatives
        FROM rounds r),
fp AS (SELECT round, candidates, verified,
              CASE WHEN candidates = 0 THEN NULL
                   ELSE (candidates - verified)::DOUBLE / candidates::DOUBLE END AS fp_rate FROM per),
fn AS (SELECT round, n_docs, candidates, false_negatives,
              CASE WHEN n_docs * (n_docs - 1) // 2 - candidates = 0 THEN NULL
                   ELSE false_negatives::DOUBLE / (n_docs * (n_docs - 1) // 2 - candidates)::DOUBLE
              END AS fn_rate FROM per)"""


def near_duplicates_sql() -> dict[str, str]:
    t = reg.LSH.threshold
    sim = _similarity_ctes()
    qual = _quality_ctes()
    q: dict[str, str] = {}
    q["doc_length_filter"] = f"SELECT doc_id, length(text) AS n_chars FROM documents " \
                             f"WHERE doc_id IS NOT NULL AND length(text) >= {reg.LSH.shingle_size}"
    q["shingles"] = _with(sim, "SELECT doc_id, shingle FROM sh")
    q["minhash"] = _with(sim, "SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY fn) AS signature "
                              "FROM mh GROUP BY doc_id")
    q["bands"] = _with(sim, "SELECT doc_id, band, band_rows FROM bands")
    q["buckets"] = _with(sim, """
SELECT band, doc_id, bucket_size FROM
  (SELECT band, doc_id, count(*) OVER (PARTITION BY band, band_rows) AS bucket_size FROM bands)
WHERE bucket_size > 1""")
    q["candidate_pairs"] = _with(sim, "SELECT first, second FROM cand")
    q["pair_similarity"] = _with(sim, "SELECT first, second, similarity FROM psim")
    q["similar_pairs"] = _with(sim, "SELECT first, second, similarity FROM simp")
    q["signature_similarity"] = _with(sim, """
SELECT c.first, c.second, count(*) FILTER (WHERE m1.v = m2.v) AS matching_rows
FROM cand c JOIN mh m1 ON m1.doc_id = c.first JOIN mh m2 ON m2.doc_id = c.second AND m2.fn = m1.fn
GROUP BY c.first, c.second""")
    q["similar_to"] = _with(sim + ",\ntox AS (SELECT doc_id FROM labels WHERE toxic = 1)", """
SELECT first AS doc_id, second AS similar_id FROM simp WHERE first IN (SELECT doc_id FROM tox)
UNION ALL
SELECT second AS doc_id, first AS similar_id FROM simp WHERE second IN (SELECT doc_id FROM tox)""")
    q["similar_to_pairs"] = q["similar_to"]
    q["exact_similar_pairs"] = _with(sim + f""",
sp AS (SELECT a.doc_id AS first, b.doc_id AS second FROM sizes a JOIN sizes b
       ON a.doc_id < b.doc_id AND least(a.n, b.n)::DOUBLE >= {t} * greatest(a.n, b.n)::DOUBLE - 1e-9),
spi AS (SELECT p.first, p.second, count(y.shingle) AS common
        FROM sp p JOIN sh x ON x.doc_id = p.first
        LEFT JOIN sh y ON y.doc_id = p.second AND y.shingle = x.shingle
        GROUP BY p.first, p.second)""", f"""
SELECT i.first, i.second, i.common::DOUBLE / (n1.n + n2.n - i.common)::DOUBLE AS similarity
FROM spi i JOIN sizes n1 ON n1.doc_id = i.first JOIN sizes n2 ON n2.doc_id = i.second
WHERE i.common::DOUBLE / (n1.n + n2.n - i.common)::DOUBLE >= {t}""")
    q["false_negatives_corpus"] = _with(sim + f""",
sp AS (SELECT a.doc_id AS first, b.doc_id AS second FROM sizes a JOIN sizes b
       ON a.doc_id < b.doc_id AND least(a.n, b.n)::DOUBLE >= {t} * greatest(a.n, b.n)::DOUBLE - 1e-9),
spi AS (SELECT p.first, p.second, count(y.shingle) AS common
        FROM sp p JOIN sh x ON x.doc_id = p.first
        LEFT JOIN sh y ON y.doc_id = p.second AND y.shingle = x.shingle
        GROUP BY p.first, p.second),
ex AS (SELECT i.first, i.second, i.common::DOUBLE / (n1.n + n2.n - i.common)::DOUBLE AS similarity
       FROM spi i JOIN sizes n1 ON n1.doc_id = i.first JOIN sizes n2 ON n2.doc_id = i.second)""", f"""
SELECT e.first, e.second, e.similarity FROM ex e
WHERE e.similarity >= {t}
  AND NOT EXISTS (SELECT 1 FROM cand c WHERE c.first = e.first AND c.second = e.second)""")
    q["doc_sample"] = _with(qual, "SELECT round, doc_id FROM samp")
    q["false_positive_rate"] = _with(qual, "SELECT * FROM fp")
    q["false_negatives"] = _with(qual, "SELECT * FROM fnp")
    q["false_negative_rate"] = _with(qual, "SELECT * FROM fn")
    q["fpfn_analysis"] = _with(qual, f"""
SELECT count(*) AS rounds, {reg.FPFN_FRACTION}::DOUBLE AS fraction,
       avg(fp_rate) AS avg_fp_rate, avg(fn_rate) AS avg_fn_rate
FROM fp JOIN fn USING (round)""")
    weak = _quality_ctes(reg.WEAK_LSH, reg.WEAK_FRACTION, reg.WEAK_ROUNDS)
    q["false_negatives_weak"] = _with(weak, "SELECT * FROM fnp")
    q["false_negative_rate_weak"] = _with(weak, "SELECT * FROM fn")
    q["fpfn_analysis_weak"] = _with(weak, f"""
SELECT count(*) AS rounds, {reg.WEAK_FRACTION}::DOUBLE AS fraction,
       avg(fp_rate) AS avg_fp_rate, avg(fn_rate) AS avg_fn_rate
FROM fp JOIN fn USING (round)""")
    return q


def all_sql() -> dict[str, str]:
    return {**market_basket_sql(), **near_duplicates_sql()}
