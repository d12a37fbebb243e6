"""Quality rules whose cutoffs carry a guarantee (DataFrame functions only).

Five rules look at one figure of a document each (share of symbols, of
repeated lines, of repeated words, of shouted words, mean word length) and
reject it above a cutoff. A cutoff is not set by hand: the labelled documents
are a holdout, and in every stratum (language) the cutoffs of a rule's fixed
ladder are tested from the mildest to the strictest. A cutoff is certified
when the exact binomial tail says that rejecting so few of the good holdout
documents would have a probability of at most ``level`` if the rule's false
rejections were above its limit. The ladder is tested in order and ends at
the first cutoff that fails (fixed-sequence testing needs no correction along
the ladder); over rules and strata the level is divided by their number
(Bonferroni). The limit ``risk`` for all rules together is shared out evenly,
so with probability ``1 - level`` no stratum loses more than ``risk`` of its
good documents. A stratum whose holdout is too small to certify anything
keeps all that the base rule keeps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.storage import materialize, release

from .common import hidden, words

# Fixed values of the base figures.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RISK = 0.05   # share of good documents that all rules together may reject in a stratum
LEVEL = 0.05  # probability that this fails in any stratum

#: rule -> its ladder of cutoffs, from the mildest to the strictest; a document fails above the cutoff
LADDERS: dict[str, tuple[float, ...]] = {
    "symbols": (0.8, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.175, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "repeats": (0.3, 0.28, 0.26, 0.24, 0.22, 0.2, 0.18, 0.16, 0.14, 0.12, 0.1),
    "shouting": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "word_length": (60.0, 40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0),
}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _sorted_windows(hashes: Column) -> Column:
    """The windows ordered by hash, or null where all differ."""
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.array_sort(pairs))


def _repeat_words(ordered: Column) -> Column:
    """Words inside windows that occur twice or more; ``ordered`` is a column of ``_sorted_windows``."""
    twin = lambda x, k, step: F.coalesce(F.get(ordered, k + step)["h"] == x["h"], F.lit(False))
    marked = F.transform(ordered, lambda x, k: F.struct(x["i"].alias("i"), (twin(x, k, -1) | twin(x, k, 1)).alias("again")))
    places = F.array_sort(F.transform(F.filter(marked, lambda x: x["again"]), lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["total"] + WINDOW - F.greatest(acc["end"] - i, F.lit(0))).alias("total"),
                                (i + WINDOW).alias("end")), lambda acc: acc["total"])
    return F.coalesce(covered, F.lit(0).cast("long"))


def figures(docs: DataFrame, text: str, keep: list[str], into: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and a struct ``into`` with the base and rule figures of the text.

    One scan, no shuffle. Windows of words are compared by 64-bit hashes
    within one text. A null text has no word.
    """
    t, w, h = hidden(docs, stem="t"), hidden(docs, stem="w"), hidden(docs, stem="h")
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(f"`{c}`") for c in keep]
    df = docs.select(*kept, body.alias(t)).select(*kept, t, words(F.col(t)).alias(w))
    n = F.size(F.col(w))
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
                                             lambda i: F.xxhash64(F.slice(F.col(w), i, WINDOW)))
                    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    line_col = f"{w}_lines"
    df = df.select(*kept, t, w, hashes.alias(h), lines.alias(line_col))
    # a column of its own: inside a lambda an expression would be worked out again for every element
    df = df.select(*kept, t, w, _sorted_windows(F.col(h)).alias(h), line_col)
    text_c = F.col(t)
    chars = F.length(_without(text_c, " \t\n\x0b\x0c\r"))
    shouted = F.size(F.filter(F.col(w), lambda x: (F.length(x) > 1) & (F.upper(x) == x) & (F.lower(x) != x)))
    base = F.struct(
        F.size(F.col(w)).cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        (F.length(text_c) - F.length(_without(text_c, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(F.col(line_col)) - F.size(F.array_distinct(F.col(line_col)))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col(h)).cast("long").alias("n_repeat_words"),
        F.size(F.col(line_col)).cast("long").alias("n_lines"), shouted.cast("long").alias("n_shouted"))
    return df.select(*kept, base.alias(into))


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def rule_values(f: Column) -> dict[str, Column]:
    """The figure each rule looks at; larger is worse."""
    share = lambda a, b: f[a] / F.greatest(f[b], F.lit(1))
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words"), "shouting": share("n_shouted", "n_words"),
            "word_length": share("word_chars", "n_words")}


def _ln_factorial(n: Column) -> Column:
    """ln n! to about 1e-11: the logarithms' sum below 10, Stirling's series from there."""
    x = n.cast("double") + 1
    small = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(10)])
    series = ((x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
              + 1 / (1260 * x * x * x * x * x))
    return F.when(n < 10, F.get(small, F.least(n, F.lit(9)).cast("int"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float, terms: int = 4096) -> Column:
    """P(Bin(n, p) <= k) for k < n p (else 1), from the point k downwards.

    The terms fall faster than a geometric series. Up to ``terms`` of them
    are added one by one; what lies beyond is covered by that series, so the
    result is exact to rounding, and never too small.
    """
    log_point = (_ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
                 + k * math.log(p) + (n - k) * math.log1p(-p))
    odds = (1 - p) / p
    steps = F.least(k, F.lit(terms))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1)).cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda acc, j: F.struct(
            (acc["term"] * F.greatest(k - j + 1, F.lit(0)) * odds / (n - k + j)).alias("term"),
            (acc["total"] + acc["term"] * F.greatest(k - j + 1, F.lit(0)) * odds / (n - k + j)).alias("total")))
    ratio = (k - terms) * odds / (n - k + terms)
    beyond = F.when(k > terms, walked["term"] * ratio / (1 - ratio)).otherwise(F.lit(0.0))
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(log_point) * (walked["total"] + beyond))).otherwise(F.lit(1.0))


def certified_cutoffs(holdout: DataFrame, risk: float = RISK, level: float = LEVEL,
                      ladders: dict[str, tuple[float, ...]] = LADDERS) -> DataFrame:
    """``(stratum, cut_<rule>...)``: the strictest certified cutoff of each rule, null where none is.

    ``holdout`` has a row per good labelled document: ``stratum`` and a struct
    ``f`` of figures.
    """
    values = rule_values(F.col("f"))
    # the first step of the ladder that rejects the document; its length if none does
    steps = F.array(*[F.struct(F.lit(rule).alias("rule"),
                               sum(F.when(values[rule] <= c, 1).otherwise(0) for c in cuts).alias("step"))
                      for rule, cuts in ladders.items()])
    counts = (holdout.select("stratum", F.explode(steps).alias("s"))
              .groupBy("stratum", F.col("s.rule").alias("rule"), F.col("s.step").alias("step"))
              .agg(F.count(F.lit(1)).alias("n")))
    counts = materialize(counts, "quality-counts")
    strata = counts.select("stratum").distinct().count()
    if strata == 0:
        strata = 1
    per_test = level / (len(ladders) * strata)
    limit = risk / len(ladders)
    grid = (counts.groupBy("stratum", "rule")
            .agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("at"))
            .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(max(map(len, ladders.values())) - 1))))
            .withColumn("k", F.aggregate(F.sequence(F.lit(0), F.col("step")), F.lit(0).cast("long"),
                                         lambda acc, j: acc + F.coalesce(F.col("at")[j], F.lit(0).cast("long")))))
    sizes = F.create_map(*[x for rule, cuts in ladders.items() for x in (F.lit(rule), F.lit(len(cuts)))])
    fails = ((F.col("step") >= sizes[F.col("rule")])
             | (binomial_tail(F.col("k"), F.col("n"), limit) > per_test))
    last = (grid.groupBy("stratum", "rule")
            .agg(F.coalesce(F.min(F.when(fails, F.col("step"))), F.max("step") + 1).alias("passed")))
    pick = lambda rule, cuts: F.max(F.when(
        (F.col("rule") == rule) & (F.col("passed") > 0),
        F.element_at(F.array(*map(F.lit, cuts)), F.least(F.col("passed"), F.lit(len(cuts))).cast("int"))))
    return last.groupBy("stratum").agg(*[pick(r, c).alias(f"cut_{r}") for r, c in ladders.items()])


def _stratum(lang: str) -> Column:
    return F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("?"))


def judge(measured: DataFrame, labels: DataFrame, key: str, lang: str, text_hash: str, f: str, risk: float,
          level: float) -> DataFrame:
    """``measured`` (stored figures) joined with its stratum's cutoffs, and the columns ``<f>_failed`` and ``<f>_kept``.

    The holdout has every good text once per stratum (copies are no
    independent draws) and no text that the base rule rejects anyway.
    """
    good = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality")).filter("quality = 1"))
    holdout = (measured.filter(~base_failed(F.col(f)))
               .select(F.col(key).alias("id"), _stratum(lang).alias("stratum"), F.col(f).alias("f"), F.col(text_hash).alias("h"))
               .join(good, F.col("id") == F.col("label_id"), "left_semi")
               .dropDuplicates(["stratum", "h"]).select("stratum", "f"))
    cutoffs = certified_cutoffs(holdout, risk, level)
    cutoffs = materialize(cutoffs.select(F.col("stratum").alias(f"{f}_stratum"),
                                         *[F.col(c).alias(f"{f}_{c}") for c in cutoffs.columns[1:]]), "quality-cutoffs")
    figures_of = F.col(f)
    over = F.lit(False)
    for rule, value in rule_values(figures_of).items():
        over = over | F.coalesce(value > F.col(f"{f}_cut_{rule}"), F.lit(False))
    return (measured.join(cutoffs, _stratum(lang) == F.col(f"{f}_stratum"), "left")
            .withColumn(f"{f}_failed", base_failed(figures_of))
            .withColumn(f"{f}_kept", ~base_failed(figures_of) & ~over))


def quality_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                   risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` per document.

    A null or empty text has no words, so it fails the base rule. Null
    languages form a stratum of their own. Labels without an id or quality
    are left out; a document labelled both good and bad counts as bad; labels
    of unknown documents don't matter. Without labels only the base rule
    rejects. Repeated rows are judged one by one; in the holdout a text counts
    once per stratum. An empty table gives no rows. Further columns are not
    read.
    """
    f, h = hidden(docs, stem="f"), hidden(docs, stem="h")
    measured = materialize(figures(docs.withColumn(h, F.xxhash64(F.col(f"`{text}`"))), text, [key, lang, h], f), "quality-figures")
    out = judge(measured, labels, key, lang, h, f, risk, level)
    return out.select(F.col(key), *[F.col(f)[c].alias(c) for c in
                                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      F.col(f"{f}_failed").alias("base_failed"), F.col(f"{f}_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
              risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    Figures and verdicts are stored without the texts; the rows that fail go
    by two hashes over all of a row's columns (equal rows have equal
    verdicts).
    """
    f, row, h = (hidden(docs, stem=x) for x in ("f", "row", "h"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(h, F.xxhash64(F.col(f"`{text}`"))).withColumn(row, F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b")))
    measured = materialize(figures(marked, text, [key, lang, h, row], f), "quality-measured")
    going = judge(measured, labels, key, lang, h, f, risk, level).filter(~F.col(f"{f}_kept")).select(row).distinct()
    going = materialize(going, "quality-going")
    # the texts pass the narrow side's hash table; they needn't be sorted
    out = marked.join(going.hint("shuffle_hash"), row, "left_anti").select(*columns)
    release(measured)
    return out


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_report(docs, labels)
