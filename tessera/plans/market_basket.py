"""The market-basket job: frequent itemsets k = 1..3, top lists and rules.

Each level is materialised (Parquet in the checkpoint folder) before the next
one uses it: the next level needs it twice (semi join and support lookup), a
materialised level has exact size statistics for the broadcast check, and a
lost executor never forces the recomputation of earlier levels.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import itemsets as its
from tessera.operators import levels as lv
from tessera.operators import rules as rl
from tessera.sources.storage import materialize, release


@dataclass
class Itemsets:
    baskets: DataFrame
    levels: dict[int, DataFrame]

    @property
    def items(self) -> DataFrame:
        return self.levels[1]

    @property
    def pairs(self) -> DataFrame:
        return self.levels[2]

    @property
    def triples(self) -> DataFrame | None:
        return self.levels.get(3)

    n_baskets_value: int | None = None
    stored: list[DataFrame] = field(default_factory=list)   # materialised tables behind the levels

    def release(self) -> None:
        """Delete the intermediate tables; nothing derived from them may run afterwards."""
        release(*self.stored)

    def n_baskets(self):
        """The number of baskets (an int when known, else a scalar-subquery column)."""
        if self.n_baskets_value is not None:
            return self.n_baskets_value
        return its.basket_count(self.baskets).scalar()


def mine_itemsets(baskets: DataFrame, min_support: its.Support, max_k: int = 3, pair_cells: int = lv.PAIR_CELLS,
                  bitmaps: bool | None = None) -> Itemsets:
    """Level-wise A-priori mining up to ``max_k`` (1, 2 or 3).

    Levels 2 and 3 are enumerated on order-preserving long codes of the items
    (the encoding join also prunes infrequent items) and decoded at the end.
    How a level is counted follows from what level 1 measured, and changes
    the plan, not the rows: where the possible pairs outnumber ``pair_cells``,
    pairs in poor cells are left out before the shuffle; where the baskets
    are dense and the candidate triples fit the kernel, triples are counted
    on bitmaps (``bitmaps`` overrules the measure).
    """
    baskets = materialize(baskets, "baskets")
    # one scalar (the basket count) reaches the driver; thresholds become literals
    n = its.basket_count(baskets).first()["n_baskets"]
    levels = {1: materialize(its.frequent_items(baskets, min_support, n), "k1", {"basket_rows": F.sum("support")})}
    stored = [baskets, levels[1]]
    if max_k >= 2:
        # a basket holds at most so many frequent items: a proven bound of every pair group
        n_items = levels[1]._tessera_rows
        codes = materialize(its.item_codes(levels[1]), "item_codes")
        pruned = its.encode_baskets(baskets, codes)
        threshold = its.absolute_support(min_support, n)
        if lv.is_wide(n_items, pair_cells):
            pairs = lv.frequent_pairs_by_cells(pruned, threshold, n_items, pair_cells)
        else:
            pairs = its.pairs_of_pruned(pruned, baskets, min_support, n, n_items)
        encoded = {2: materialize(pairs, "k2_codes")}
        if max_k >= 3:
            n_rows = int(levels[1]._tessera_metrics["basket_rows"] or 0)  # (basket, frequent item) rows
            triples = None
            if lv.is_dense(n_rows, n, n_items) if bitmaps is None else bitmaps:
                candidates = materialize(its.candidate_triples(encoded[2]), "k3_candidates")
                stored.append(candidates)
                if candidates._tessera_rows <= lv.MAX_CANDIDATES:
                    triples = lv.count_by_bitmaps(pruned, candidates, n_rows).filter(F.col("support") >= threshold)
            if triples is None:
                triples = its.triples_of_pruned(pruned, encoded[2], baskets, min_support, n, n_items)
            encoded[3] = materialize(triples, "k3_codes")
        stored += [codes, *encoded.values()]
        for k, level in encoded.items():
            levels[k] = its.decode_itemsets(level, codes)
            levels[k]._tessera_rows = level._tessera_rows   # the decode joins are 1:1
    return Itemsets(baskets, levels, n, stored)


def rules_for(mined: Itemsets, min_std_lift: float = 0.2) -> DataFrame:
    return rl.association_rules(mined.items, mined.pairs, mined.triples,
                                mined.n_baskets(), min_std_lift)
