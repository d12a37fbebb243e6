"""One-call jobs producing the same artefacts as the two original batch scripts.

``market_basket_job``: frequent itemset tables (k = 1, 2, 3) as gzip Parquet,
top-10 pair and triple reports (tab-separated, descriptions), and the
association-rule lines as text.

``near_duplicate_job``: MinHash signatures and verified similar pairs as
gzip Parquet, optionally the partners of given documents and a
false-positive / false-negative report over seeded samples.

Outputs are written by the executors to the given folder (any Hadoop file
system); the returned DataFrames read those outputs, and the intermediate
tables of a job are deleted when it is done.

With ``reuse`` (a :class:`ResultStore`) the itemset levels, the signatures and
the verified pairs are kept there, addressed by parameters and input files: a
job that is started again reads what an earlier one finished, and a changed
input or parameter is computed anew.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import itemsets as its
from tessera.operators import rules as rl
from tessera.operators import similarity as sim
from tessera.plans.market_basket import Itemsets, mine_itemsets
from tessera.plans.near_duplicates import LshParams, NearDuplicates, analyze_quality, find_near_duplicates
from tessera.sources import sinks
from tessera.sources.store import ResultStore


@dataclass
class MarketBasketOutput:
    levels: dict[int, DataFrame]   # k -> (items, item..., support)
    n_baskets: int
    rules: DataFrame
    lines: DataFrame


def _mined(events: DataFrame, basket_col: str, item_col: str, min_support: its.Support, reuse: ResultStore | None) -> Itemsets:
    baskets = its.basket_distinct(events, basket_col, item_col)
    if reuse is None:
        return mine_itemsets(baskets, min_support)
    built: list[Itemsets] = []

    def mined() -> Itemsets:
        if not built:
            built.append(mine_itemsets(baskets, min_support))
        return built[0]

    params = {"basket": basket_col, "item": item_col, "min_support": min_support}
    levels = {k: reuse.get(f"frequent_k{k}", params, [events], lambda k=k: mined().levels[k]) for k in (1, 2, 3)}
    count = reuse.get("basket_count", {"basket": basket_col, "item": item_col}, [events], lambda: its.basket_count(baskets))
    out = Itemsets(baskets, levels, count.first()["n_baskets"])
    for m in built:
        m.release()
    return out


def market_basket_job(events: DataFrame, out_dir: str, basket_col: str, item_col: str,
                      description_col: str | None = None, min_support: its.Support = 1000,
                      min_std_lift: float = 0.2, top_n: int = 10, reuse: ResultStore | None = None) -> MarketBasketOutput:
    """Mine itemsets k <= 3 and rules from ``(basket, item[, description])`` rows."""
    spark, out = events.sparkSession, out_dir.rstrip("/")
    if description_col:
        dictionary = its.item_dictionary(events, item_col, description_col)
    else:
        dictionary = events.select(F.col(item_col).alias("item")).distinct().select(
            "item", F.col("item").alias("description"))
    mined = _mined(events, basket_col, item_col, min_support, reuse)
    for k, level in mined.levels.items():
        cols = ["item"] if k == 1 else [f"item_{i}" for i in range(1, k + 1)]
        sinks.write_parquet(level.select(its.itemset_array(level).alias("items"), *cols, "support"),
                            f"{out}/frequent_k{k}")
    sinks.write_top_itemsets_tsv(its.top_itemsets(mined.pairs, dictionary, top_n), f"{out}/most_frequent_k2", "pair")
    sinks.write_top_itemsets_tsv(its.top_itemsets(mined.triples, dictionary, top_n), f"{out}/most_frequent_k3",
                                 "triple")
    rules = rl.association_rules(mined.items, mined.pairs, mined.triples, mined.n_baskets(), min_std_lift)
    sinks.write_parquet(rules, f"{out}/rules")
    rules = spark.read.parquet(f"{out}/rules")
    sinks.write_rule_lines(rl.rule_lines(rules, dictionary), f"{out}/association_rules")
    mined.release()
    return MarketBasketOutput({k: spark.read.parquet(f"{out}/frequent_k{k}") for k in mined.levels}, mined.n_baskets(),
                              rules, spark.read.text(f"{out}/association_rules").withColumnRenamed("value", "line"))


@dataclass
class NearDuplicateOutput:
    signatures: DataFrame
    similar_pairs: DataFrame
    lookup: DataFrame | None
    quality: DataFrame | None      # one row: both rates averaged over the rounds


def near_duplicate_job(docs: DataFrame, out_dir: str, id_col: str = "doc_id", text_col: str = "text",
                       params: LshParams = LshParams(), similar_to: DataFrame | None = None,
                       fpfn_fraction: float | None = None, fpfn_rounds: int = 1,
                       reuse: ResultStore | None = None) -> NearDuplicateOutput:
    """Signatures, verified similar pairs, optional lookup and FP/FN analysis."""
    spark, out = docs.sparkSession, out_dir.rstrip("/")
    found: list[NearDuplicates] = []

    def nd() -> NearDuplicates:
        if not found:
            found.append(find_near_duplicates(docs, params, id_col, text_col))
        return found[0]

    signed = lambda: nd().signatures.select(F.col("doc_id").alias(id_col), "signature")
    similar = lambda: nd().similar_pairs()
    if reuse is not None:
        key = asdict(params) | {"id": id_col, "text": text_col}
        kept = {"minhash": reuse.get("minhash", key, [docs], signed), "pairs": reuse.get("similar_pairs", key, [docs], similar)}
        signed, similar = (lambda: kept["minhash"]), (lambda: kept["pairs"])
    sinks.write_parquet(signed(), f"{out}/minhash")
    sinks.write_parquet(similar(), f"{out}/similar_pairs")
    pairs = spark.read.parquet(f"{out}/similar_pairs")
    lookup = quality = None
    if similar_to is not None:
        wanted = sim.similar_to(pairs, similar_to.select(F.col(id_col).alias("doc_id")))
        sinks.write_parquet(wanted, f"{out}/similar_to")
        lookup = spark.read.parquet(f"{out}/similar_to")
    if fpfn_fraction is not None:
        report = analyze_quality(nd(), fpfn_fraction, fpfn_rounds)
        sinks.write_parquet(report.fp.join(report.fn.drop("candidates"), "round"), f"{out}/fpfn_rounds")
        sinks.write_parquet(report.summary, f"{out}/fpfn_summary")
        quality = spark.read.parquet(f"{out}/fpfn_summary")
    for run in found:
        run.release()
    return NearDuplicateOutput(spark.read.parquet(f"{out}/minhash"), pairs, lookup, quality)
