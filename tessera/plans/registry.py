"""Named jobs over a scale-factor folder: ``name -> (spark, sf_dir) -> DataFrame``.

These bind the operators to the test tables with fixed parameters; every job
reads whole tables. Array-valued results are flattened to scalar columns
(``array_join``) so they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import itemsets as its
from tessera.operators import rules as rl
from tessera.plans import catalog
from tessera.operators import quality as qa
from tessera.operators import similarity as sim
from tessera.plans.market_basket import mine_itemsets
from tessera.plans.lsh_index import build_index
from tessera.plans.near_duplicates import LshParams, analyze_quality, exact_key_pairs, pairs_of_signed, sign_documents
from tessera.sources.readers import load_csv, load_json, read_table
from tessera.sources.sinks import read_ordered, write_ordered, write_top_itemsets_tsv
from tessera.sources.storage import new_folder
from tessera.sources.store import ResultStore, path_fingerprint

# Fixed job parameters (relative supports keep their meaning across scale factors).
ORDER_BRAND_SUPPORT = 0.004      # fraction of orders
USER_K_SUPPORT = 0.16            # fraction of users
CUSTOMER_BRAND_SUPPORT = 0.55    # fraction of customers: prunes pairs and triples
PRUNE_SUPPORT = 0.025            # order x brand|type: leaves a strict subset of items
MIN_STD_LIFT = 0.2
TOP_N = 10
LSH = LshParams()                # k = 9, b = 13, r = 11, seed = 1, threshold = 0.85
FPFN_FRACTION = 0.1
FPFN_ROUNDS = 3
WEAK_LSH = LshParams(bands=2, rows=25)   # misses pairs, so that there are false negatives to report
WEAK_FRACTION = 0.3
WEAK_ROUNDS = 2

Query = Callable[[SparkSession, str], DataFrame]


# Materialised intermediate results, reused by the jobs of one application
# (they live in the checkpoint folder) as long as the files of the tables that
# they come from are the same; ``clear_cache`` forces recomputation.
_CACHE: dict = {}


def clear_cache() -> None:
    _CACHE.clear()


_BASKET_TABLES = ("lineitem", "part", "orders", "events")


def _version(spark: SparkSession, sf_dir: str, *tables: str) -> tuple:
    """Application, folder and state of the tables' files."""
    return (spark.sparkContext.applicationId, sf_dir,
            path_fingerprint(spark, *[f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]))


def _memo(version: tuple, key: tuple, build):
    full = (*version, *key)
    if full not in _CACHE:
        _CACHE[full] = build()
    return _CACHE[full]


_BASKETS = {
    "order_brand": (catalog.order_brand_baskets, ORDER_BRAND_SUPPORT),
    "user_k": (catalog.user_k_baskets, USER_K_SUPPORT),
    "customer_brand": (catalog.customer_brand_baskets, CUSTOMER_BRAND_SUPPORT),
}


def _mined(spark, sf_dir, kind="order_brand", max_k=3):
    """Levels up to ``max_k``; a run that went further is used where there is one."""
    baskets, support = _BASKETS[kind]
    version = _version(spark, sf_dir, *_BASKET_TABLES)
    for k in range(3, max_k, -1):
        if (found := _CACHE.get((*version, "itemsets", kind, support, k))) is not None:
            return found
    return _memo(version, ("itemsets", kind, support, max_k),
                 lambda: mine_itemsets(baskets(spark, sf_dir), support, max_k))


def _signed(spark, sf_dir, params=LSH):
    return _memo(_version(spark, sf_dir, "documents"), ("signed", params),
                 lambda: sign_documents(catalog.documents(spark, sf_dir), params))


def _near_dups(spark, sf_dir, params=LSH):
    return _memo(_version(spark, sf_dir, "documents"), ("near_dups", params),
                 lambda: pairs_of_signed(_signed(spark, sf_dir, params)))


def _index(spark, sf_dir):
    return _memo(_version(spark, sf_dir, "documents"), ("index", LSH),
                 lambda: build_index(_signed(spark, sf_dir), new_folder(spark, "lsh-index")))


def _quality(spark, sf_dir, params=LSH, fraction=FPFN_FRACTION, rounds=FPFN_ROUNDS):
    return _memo(_version(spark, sf_dir, "documents"), ("quality", params, fraction, rounds),
                 lambda: analyze_quality(_near_dups(spark, sf_dir, params), fraction, rounds))


def _exact(spark, sf_dir):
    return _memo(_version(spark, sf_dir, "documents"), ("exact", LSH), lambda: exact_key_pairs(_near_dups(spark, sf_dir)))


def _flat_rules(df: DataFrame) -> DataFrame:
    cols = [F.array_join("lhs", ",").alias("lhs") if c == "lhs" else F.col(c) for c in df.columns]
    return df.select(*cols)


# ------------------------------------------------------------------ market basket

def q_item_dictionary(spark, sf_dir):
    return catalog.brand_dictionary(spark, sf_dir)


def q_basket_distinct(spark, sf_dir):
    return catalog.order_brand_baskets(spark, sf_dir)


def q_basket_count(spark, sf_dir):
    return its.basket_count(catalog.order_brand_baskets(spark, sf_dir))


def q_frequent_items(spark, sf_dir):
    return its.frequent_items(catalog.order_brand_baskets(spark, sf_dir), ORDER_BRAND_SUPPORT)


def q_prune_infrequent(spark, sf_dir):
    b = catalog.order_brand_type_baskets(spark, sf_dir)
    return its.prune_infrequent(b, its.frequent_items(b, PRUNE_SUPPORT))


def q_basket_itemlists(spark, sf_dir):
    b = catalog.order_brand_type_baskets(spark, sf_dir)
    lists = its.basket_itemlists(b, its.frequent_items(b, PRUNE_SUPPORT))
    return lists.select("basket", F.array_join("items", ";").alias("items"))


def q_frequent_pairs(spark, sf_dir):
    return _mined(spark, sf_dir, max_k=2).pairs


def q_candidate_triples(spark, sf_dir):
    return its.candidate_triples(_mined(spark, sf_dir, max_k=2).pairs)


def q_frequent_triples(spark, sf_dir):
    return _mined(spark, sf_dir).triples


def q_frequent_pairs_user_k(spark, sf_dir):
    return _mined(spark, sf_dir, "user_k", max_k=2).pairs


def q_frequent_triples_user_k(spark, sf_dir):
    return _mined(spark, sf_dir, "user_k").triples


def q_frequent_pairs_customer_brand(spark, sf_dir):
    return _mined(spark, sf_dir, "customer_brand", max_k=2).pairs


def q_candidate_triples_customer_brand(spark, sf_dir):
    return its.candidate_triples(_mined(spark, sf_dir, "customer_brand", max_k=2).pairs)


def q_frequent_triples_customer_brand(spark, sf_dir):
    return _mined(spark, sf_dir, "customer_brand").triples


def q_association_rules_customer_brand(spark, sf_dir):
    m = _mined(spark, sf_dir, "customer_brand")
    return _flat_rules(rl.association_rules(m.items, m.pairs, m.triples, m.n_baskets(), 0.0))


def q_itemset_counts(spark, sf_dir):
    return its.itemset_counts(_mined(spark, sf_dir).levels)


def q_top_pairs(spark, sf_dir):
    top = its.top_itemsets(_mined(spark, sf_dir, max_k=2).pairs,
                           catalog.brand_dictionary(spark, sf_dir), TOP_N)
    return top.select("rank", "item_1", "item_2", "description_1", "description_2", "support")


def q_top_triples(spark, sf_dir):
    top = its.top_itemsets(_mined(spark, sf_dir).triples, catalog.brand_dictionary(spark, sf_dir), TOP_N)
    return top.select("rank", "item_1", "item_2", "item_3", "description_1", "description_2",
                      "description_3", "support")


def q_label_itemsets(spark, sf_dir):
    return its.label_itemsets(_mined(spark, sf_dir, max_k=2).pairs, catalog.brand_dictionary(spark, sf_dir))


def q_rule_generation(spark, sf_dir):
    m = _mined(spark, sf_dir)
    rules = rl.rule_generation(m.pairs).unionByName(rl.rule_generation(m.triples))
    return _flat_rules(rules)


def q_rules_pairs(spark, sf_dir):
    m = _mined(spark, sf_dir, max_k=2)
    return _flat_rules(rl.rule_counts(rl.rule_generation(m.pairs), m.items, [m.items]))


def q_rules_triples(spark, sf_dir):
    m = _mined(spark, sf_dir)
    return _flat_rules(rl.rule_counts(rl.rule_generation(m.triples), m.items, [m.items, m.pairs]))


def q_rule_metrics(spark, sf_dir):
    m = _mined(spark, sf_dir)
    n = m.n_baskets()
    scored = rl.scored_rules(m.pairs, m.items, [m.items], n).unionByName(
        rl.scored_rules(m.triples, m.items, [m.items, m.pairs], n))
    return _flat_rules(scored.select(*rl.RULE_COLUMNS))


def q_association_rules(spark, sf_dir):
    m = _mined(spark, sf_dir)
    return _flat_rules(rl.association_rules(m.items, m.pairs, m.triples, m.n_baskets(), MIN_STD_LIFT))


def q_association_rules_user_k(spark, sf_dir):
    m = _mined(spark, sf_dir, "user_k")
    return _flat_rules(rl.association_rules(m.items, m.pairs, m.triples, m.n_baskets(), MIN_STD_LIFT))


def q_rule_lines(spark, sf_dir):
    m = _mined(spark, sf_dir)
    rules = rl.association_rules(m.items, m.pairs, m.triples, m.n_baskets(), MIN_STD_LIFT)
    return rl.rule_lines(rules, catalog.brand_dictionary(spark, sf_dir)).select("line")


def q_materialize(spark, sf_dir):
    """Frequent items through the result store: built where they are absent, then read back."""
    store = ResultStore(spark)
    inputs = [read_table(spark, sf_dir, t) for t in ("lineitem", "part")]
    params = {"baskets": "order_brand", "min_support": ORDER_BRAND_SUPPORT}
    store.get("frequent_items", params, inputs, lambda: q_frequent_items(spark, sf_dir))
    return store.find("frequent_items", params, inputs)


# ------------------------------------------------------------------ sources and sinks

def q_csv_scan(spark, sf_dir):
    """The events table written as CSV (gzip, with header) and read back by type."""
    path = new_folder(spark, "events-csv")
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    events.write.options(header=True, quote='"', escape='"', compression="gzip", emptyValue='""').csv(path)
    return load_csv(spark, path, {"event_id": "bigint", "user_id": "bigint", "value": "double"}).good


def q_json_scan(spark, sf_dir):
    """The documents table written as JSON lines (bz2) and read back by type."""
    path = new_folder(spark, "documents-json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.option("compression", "bzip2").json(path)
    good = load_json(spark, path, docs.schema).good
    return good.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "n_chars")


def q_text_sink(spark, sf_dir):
    """Rule lines written as text in order, over several files, and read back with their ranks."""
    m = _mined(spark, sf_dir)
    rules = rl.association_rules(m.items, m.pairs, m.triples, m.n_baskets(), MIN_STD_LIFT)
    lines = rl.rule_lines(rules, catalog.brand_dictionary(spark, sf_dir)).select("line")
    path = new_folder(spark, "rule-lines")
    write_ordered(lines, [F.col("line").desc()], path)
    return read_ordered(spark, path, "text", lines.schema)


def q_top_pairs_tsv(spark, sf_dir):
    """The tab-separated report of the top pairs, read back."""
    path = new_folder(spark, "top-pairs")
    top = its.top_itemsets(_mined(spark, sf_dir, max_k=2).pairs, catalog.brand_dictionary(spark, sf_dir), TOP_N)
    write_top_itemsets_tsv(top, path, "pair")
    return spark.read.schema("pair string, count bigint").options(sep="\t", header=True).csv(path)


def q_parquet_sink(spark, sf_dir):
    """Frequent pairs written as gzip Parquet in order of support, over several files, and read back with their ranks."""
    pairs, path = _mined(spark, sf_dir, max_k=2).pairs.select("item_1", "item_2", "support"), new_folder(spark, "pairs-parquet")
    write_ordered(pairs, [F.col("support").desc(), "item_1", "item_2"], path, "parquet", {"compression": "gzip"})
    return read_ordered(spark, path, "parquet", pairs.schema)


MARKET_BASKET: dict[str, Query] = {
    "csv_scan": q_csv_scan,
    "json_scan": q_json_scan,
    "text_sink": q_text_sink,
    "top_pairs_tsv": q_top_pairs_tsv,
    "parquet_sink": q_parquet_sink,
    "materialize": q_materialize,
    "item_dictionary": q_item_dictionary,
    "basket_distinct": q_basket_distinct,
    "basket_count": q_basket_count,
    "frequent_items": q_frequent_items,
    "prune_infrequent": q_prune_infrequent,
    "basket_itemlists": q_basket_itemlists,
    "frequent_pairs": q_frequent_pairs,
    "candidate_triples": q_candidate_triples,
    "frequent_triples": q_frequent_triples,
    "frequent_pairs_user_k": q_frequent_pairs_user_k,
    "frequent_triples_user_k": q_frequent_triples_user_k,
    "frequent_pairs_customer_brand": q_frequent_pairs_customer_brand,
    "candidate_triples_customer_brand": q_candidate_triples_customer_brand,
    "frequent_triples_customer_brand": q_frequent_triples_customer_brand,
    "association_rules_customer_brand": q_association_rules_customer_brand,
    "itemset_counts": q_itemset_counts,
    "top_pairs": q_top_pairs,
    "top_triples": q_top_triples,
    "label_itemsets": q_label_itemsets,
    "rule_generation": q_rule_generation,
    "rules_pairs": q_rules_pairs,
    "rules_triples": q_rules_triples,
    "rule_metrics": q_rule_metrics,
    "association_rules": q_association_rules,
    "association_rules_user_k": q_association_rules_user_k,
    "rule_lines": q_rule_lines,
}


# ------------------------------------------------------------------ near duplicates

def q_doc_length_filter(spark, sf_dir):
    kept = sim.doc_length_filter(catalog.documents(spark, sf_dir), LSH.shingle_size)
    return kept.select("doc_id", F.length("text").alias("n_chars"))


def q_shingles(spark, sf_dir):
    sh = _near_dups(spark, sf_dir).shingles()
    return sh.select("doc_id", F.explode("shingles").alias("shingle"))


def q_minhash(spark, sf_dir):
    sig = _near_dups(spark, sf_dir).signatures
    return sig.select("doc_id", F.array_join("signature", ",").alias("signature"))


def q_bands(spark, sf_dir):
    sig = _near_dups(spark, sf_dir).signatures.select("doc_id", "signature")
    slices = sim.band_slices(sig, LSH.bands, LSH.rows)
    return slices.select("doc_id", "band", F.array_join("band_rows", ",").alias("band_rows"))


def q_buckets(spark, sf_dir):
    sig = _near_dups(spark, sf_dir).signatures.select("doc_id", "signature")
    return sim.buckets(sim.lsh_bands(sig, LSH.bands, LSH.rows)).select("band", "doc_id", "bucket_size")


def q_candidate_pairs(spark, sf_dir):
    return _near_dups(spark, sf_dir).candidate_pairs()


def q_pair_similarity(spark, sf_dir):
    return _near_dups(spark, sf_dir).pair_similarity()


def q_similar_pairs(spark, sf_dir):
    return _near_dups(spark, sf_dir).similar_pairs()


def q_signature_similarity(spark, sf_dir):
    nd = _near_dups(spark, sf_dir)
    out = sim.signature_similarity(nd.candidate_pairs(), nd.signatures.select("doc_id", "signature"))
    return out.select("first", "second", "matching_rows")


def q_similar_to(spark, sf_dir):
    """Near duplicates of every document labelled toxic, looked up in the stored index."""
    queries = catalog.documents(spark, sf_dir).join(catalog.toxic_documents(spark, sf_dir), "doc_id", "left_semi")
    return _index(spark, sf_dir).lookup(queries).select("doc_id", "similar_id")


def q_similar_to_pairs(spark, sf_dir):
    """The same from the table of all similar pairs."""
    queries = catalog.toxic_documents(spark, sf_dir)
    return sim.similar_to(_near_dups(spark, sf_dir).similar_pairs(), queries)


def q_exact_similar_pairs(spark, sf_dir):
    nd = _near_dups(spark, sf_dir)
    return nd.expand(_exact(spark, sf_dir), {"similarity": 1.0})


def q_false_negatives_corpus(spark, sf_dir):
    """Pairs with Jaccard >= threshold over the whole corpus that LSH did not propose."""
    nd = _near_dups(spark, sf_dir)
    fn_keys = qa.false_negative_key_pairs(_exact(spark, sf_dir), nd.key_candidates)
    return nd.expand(fn_keys, include_copies=False)


def q_doc_sample(spark, sf_dir):
    return _quality(spark, sf_dir).sample


def q_false_positive_rate(spark, sf_dir):
    return _quality(spark, sf_dir).fp


def q_false_negatives(spark, sf_dir):
    return _quality(spark, sf_dir).fn_pairs


def q_false_negative_rate(spark, sf_dir):
    return _quality(spark, sf_dir).fn


def q_fpfn_analysis(spark, sf_dir):
    return _quality(spark, sf_dir).summary


def q_false_negatives_weak(spark, sf_dir):
    return _quality(spark, sf_dir, WEAK_LSH, WEAK_FRACTION, WEAK_ROUNDS).fn_pairs


def q_false_negative_rate_weak(spark, sf_dir):
    return _quality(spark, sf_dir, WEAK_LSH, WEAK_FRACTION, WEAK_ROUNDS).fn


def q_fpfn_analysis_weak(spark, sf_dir):
    return _quality(spark, sf_dir, WEAK_LSH, WEAK_FRACTION, WEAK_ROUNDS).summary


NEAR_DUPLICATES: dict[str, Query] = {
    "doc_length_filter": q_doc_length_filter,
    "shingles": q_shingles,
    "minhash": q_minhash,
    "bands": q_bands,
    "buckets": q_buckets,
    "candidate_pairs": q_candidate_pairs,
    "pair_similarity": q_pair_similarity,
    "similar_pairs": q_similar_pairs,
    "signature_similarity": q_signature_similarity,
    "similar_to": q_similar_to,
    "similar_to_pairs": q_similar_to_pairs,
    "exact_similar_pairs": q_exact_similar_pairs,
    "false_negatives_corpus": q_false_negatives_corpus,
    "doc_sample": q_doc_sample,
    "false_positive_rate": q_false_positive_rate,
    "false_negatives": q_false_negatives,
    "false_negative_rate": q_false_negative_rate,
    "fpfn_analysis": q_fpfn_analysis,
    "false_negatives_weak": q_false_negatives_weak,
    "false_negative_rate_weak": q_false_negative_rate_weak,
    "fpfn_analysis_weak": q_fpfn_analysis_weak,
}


def all_queries() -> dict[str, Query]:
    return {**MARKET_BASKET, **NEAR_DUPLICATES}
