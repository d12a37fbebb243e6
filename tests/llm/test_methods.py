"""The methods' inner figures against plain Python: importances, gradients, logits, cutoffs."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from frames import words
from pyspark.sql import functions as F

from tessera.llm import main_text, quality, toxicity

# ------------------------------------------------------------------ site style tree


def importances(pages, min_pages):
    """``(host, path) -> (pages, content, presentation)`` over distinct pages."""
    distinct = {}
    for host, page in pages:
        blocks, layouts = main_text.page_blocks(page)
        distinct[host, "\n".join(t for _, t in blocks)] = (blocks, layouts)
    texts, shapes, having = defaultdict(Counter), defaultdict(Counter), Counter()
    for (host, _), (blocks, layouts) in distinct.items():
        above = {">".join(p.split(">")[:k]) for p, _ in blocks for k in range(1, len(p.split(">")) + 1)}
        for path, text in set(blocks):
            texts[host, path][text] += 1
        for path, shape in dict(layouts).items():
            if path in above:
                shapes[host, path][shape] += 1
        for path in {p for p, _ in blocks}:
            having[host, path] += 1
    out = {}
    nodes = {(host, ">".join(path.split(">")[:k])) for host, path in texts for k in range(1, len(path.split(">")) + 1)}
    for host, node in nodes:
        under = [(h, p) for h, p in texts if h == host and (p == node or p.startswith(node + ">"))]
        m = max(having[x] for x in under)
        klogk = sum(k * math.log(k) for x in under for k in texts[x].values())
        most = sum(sum(texts[x].values()) * math.log(having[x]) for x in under)
        n = sum(shapes[host, node].values())
        entropy = 1.0 if n == 1 else 0.0 if n == 0 else -sum(
            k / n * math.log(k / n) for k in shapes[host, node].values()) / math.log(n)
        known = m >= min_pages
        out[host, node] = (m, 1 - klogk / most if known and most > 0 else 1.0, entropy if known else 1.0)
    return out


def host_pages():
    rng = random.Random(5)
    pages = []
    for host in ("a", "b"):
        for i in range(14):
            box = "<div><span>Read on</span><ul><li>Home pages</li><li>Contact us all</li></ul></div>" if host == "a" or i % 2 else ""
            more = f"<section><p>{' '.join(words(rng, 6))}</p></section>" if i % 3 == 0 else ""
            pages.append((host, f"<html><body>{box}<div><p>{' '.join(words(rng, 30))}</p>{more}<p>One line for all</p></div></body></html>"))
    return pages + pages[:3]  # repeated pages count once


def test_importances_equal_plain_ones(spark):
    pages = host_pages()
    df = spark.createDataFrame([(i, f"http://{h}/", h, p) for i, (h, p) in enumerate(pages)],
                               "page_id long, url string, host string, html string")
    parsed = df.mapInArrow(main_text._parsed, main_text._DDL)
    for min_pages in (8, 20):
        got = {(r.host, r.path): (r.pages, r.content, r.presentation) for r in main_text.style_tree(parsed, min_pages).collect()}
        want = importances(pages, min_pages)
        assert got.keys() == want.keys()
        for node, (m, content, presentation) in want.items():
            assert got[node][0] == m
            assert math.isclose(got[node][1], content, abs_tol=1e-9) and math.isclose(got[node][2], presentation, abs_tol=1e-9)
    assert {c for (h, p), (_, c, s) in importances(pages, 8).items() if h == "a" and c < 0.1 and s < 0.1}


# ------------------------------------------------------------------ subword bags

def sample(n=60, seed=3):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randint(1, 20)) + (["idiot", "moron"] if i % 3 == 0 else [])) for i in range(n)]
    return texts, np.array([i % 3 == 0 for i in range(n)])


def test_step_follows_the_gradient():
    texts, toxic = sample()
    w = toxicity._Windows(texts)
    rng = np.random.default_rng(1)
    of = np.arange(0, len(w.doc), 2)
    target, weight = toxic[w.doc[of]].astype(int), rng.random(len(of))
    state = {"table": rng.normal(0, 0.5, (toxicity.BUCKETS, toxicity.DIM)), "out": rng.normal(0, 0.5, (toxicity.DIM, 2)),
             "bias": rng.normal(0, 0.5, 2)}

    def loss(s):
        z = w.averages(w.word_sums(s["table"]), of) @ s["out"] + s["bias"]
        z = z - z.max(axis=1, keepdims=True)
        return float((weight * (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(of)), target])).sum())

    used = np.unique(w.bucket)
    places = [("bias", (k,)) for k in range(2)] + [("out", (k, c)) for k in range(0, toxicity.DIM, 5) for c in range(2)]
    places += [("table", (int(b), int(rng.integers(toxicity.DIM)))) for b in rng.choice(used, 12, replace=False)]
    slopes = {}
    for name, at in places:
        both = []
        for step in (1e-5, -1e-5):
            moved = state | {name: state[name].copy()}
            moved[name][at] += step
            both.append(loss(moved))
        slopes[name, at] = (both[0] - both[1]) / 2e-5
    run = {k: v.copy() for k, v in state.items()} | {"t": 0, "m": {k: np.zeros_like(v) for k, v in state.items()},
                                                     "v": {k: np.zeros_like(v) for k, v in state.items()}}
    toxicity._step(w, of, target, weight, run)
    for (name, at), slope in slopes.items():
        assert math.isclose(run["m"][name][at] / 0.1, slope, rel_tol=1e-4, abs_tol=1e-7), (name, at)
        if abs(slope) > 1e-4:  # the first step of Adam is the rate against the sign
            assert math.isclose(run[name][at] - state[name][at], -toxicity.RATE * np.sign(slope), rel_tol=1e-2)


def test_logit_equals_a_plain_loop():
    rng = np.random.default_rng(4)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS), 0.25, 0.0, 1.0)
    for text in [*sample(25)[0], "one", "Zwei Worte, drei", "a b c d e f g h", "x  y\tz, und-noch (etwas) mehr davon hier"]:
        # n-grams don't reach over a border, so a word has the same ones alone
        each = [[model.weights[b] for b in toxicity.ngrams(word)[1]] for word in re.findall(r"[^\W_]+", text.lower())]
        windows = [each[i:i + toxicity.WINDOW] for i in range(max(1, len(each) - toxicity.WINDOW + 1))]
        want = max(sum(map(sum, some)) / sum(map(len, some)) for some in windows) + 0.25
        assert math.isclose(model.logit(text), want, rel_tol=1e-9), text
    assert model.logit("") is None and model.logit("... !") is None


# ------------------------------------------------------------------ certified cutoffs

def test_cutoffs_equal_plain_ones(spark):
    rng = random.Random(7)
    values = {"en": [rng.betavariate(1, 30) for _ in range(1500)], "de": [rng.betavariate(1, 9) for _ in range(900)],
              "fr": [rng.random() * 0.01 for _ in range(120)]}
    n_words = 10_000
    rows = [(s, n_words, n_words * 5, round(v * n_words * 5), 0, 0, 0) for s, of in values.items() for v in of]
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouted"]
    known = quality.figures(spark.createDataFrame([(1, "x")], "doc_id long, text string"), "text", ["doc_id"], "f").select("f.*").columns
    df = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{c} long" for c in fields))
    df = df.select("stratum", F.struct(*[F.col(c) if c in fields else F.lit(0).cast("long").alias(c) for c in known]).alias("f"))
    got = {r.stratum: r.cut_symbols for r in quality.certified_cutoffs(df).collect()}
    rules, level = len(quality.LADDERS), 0.05

    def tail(k, n, p):
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                            + (n - i) * math.log1p(-p)) for i in range(k + 1))
    figure = df.select("stratum", quality.rule_values(F.col("f"))["symbols"].alias("v")).collect()
    for stratum in values:
        of = [r.v for r in figure if r.stratum == stratum]
        want = None
        for cut in quality.LADDERS["symbols"]:
            k = sum(v > cut for v in of)
            if k >= len(of) * 0.05 / rules or tail(k, len(of), 0.05 / rules) > level / (rules * len(values)):
                break
            want = cut
        assert got[stratum] == want, stratum
    assert got["fr"] is None and got["en"] is not None
