"""Toxicity scores from subword-bag embeddings under a linear softmax, trained in numpy.

A word is the bag of its character 3- to 5-grams (with its borders) and of
itself, hashed into a table of embeddings; a window of a few words is the average of all
their n-gram vectors, and a linear softmax scores it. A misspelled word keeps
most of its n-grams, so it is scored by what was learned for its neighbours.
Embeddings and softmax are trained together. A label belongs to a whole text
while its reason may be one word in thousands, so training starts from all
windows of a text and then keeps to those that the model itself finds
strongest; a text's score is that of its strongest window, over the whole
text.

As the output is linear in the average, the trained model folds into one
number per n-gram bucket. That table is all the executors get.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 17
DIM = 8
SIZES = (3, 4, 5)
WINDOW, STRIDE = 6, 3         # words of a window, words from one to the next in training (scores take every window)
SAMPLE = 1500                 # labelled texts of each class that are trained on, at most
SAMPLE_CHARS = 20_000         # longer texts aren't trained on (they are scored like all others)
MIN_TEXTS = 4                 # texts of the sample in which an n-gram has to stand to be learned
ROUNDS = (16, 12, 12, 12)      # epochs before each new choice of the strongest windows
RATE = 0.05
SEED = 8
CUT = 0.7                     # the score at which a text is called toxic

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
with np.errstate(over="ignore"):
    _PLACES = np.cumprod(np.full(64, _M1, np.uint64))
_WORDS = re.compile(r"[^\W_]+")
_FLAGS: list[np.ndarray] = []


def _word_chars() -> np.ndarray:
    """Which code points belong to words; beyond the table all do."""
    if not _FLAGS:
        _FLAGS.append(np.array([chr(c).isalnum() for c in range(0x3000)]))
    return _FLAGS[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """``(word, bucket)`` of all n-grams of a text, ordered by word for each size, and a bound of the words' numbers.

    Everything runs over arrays: characters outside words become one border
    sign between words, and an n-gram is a stretch without a border inside.
    """
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    flags = _word_chars()
    solid = flags[np.minimum(c, len(flags) - 1)] | (c >= len(flags))
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # a word and the one sign behind it
    c = np.concatenate([[1], np.where(solid, c, 1)[keep], [1]]).astype(np.uint64)
    border = c == 1
    upto = np.cumsum(border)  # borders up to and with each place
    words, buckets = [], []
    with np.errstate(over="ignore"):
        h = (c[:-1] + np.uint64(7)) * _M1 + c[1:]
        for n in range(3, max(SIZES) + 1):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] ^ (h[:len(c) - n + 1] >> np.uint64(29))) * _M2 + c[n - 1:]
            if n not in SIZES:
                continue
            inner = upto[n - 2:len(c) - 1] == upto[:len(c) - n + 1]  # no border behind the first sign, before the last
            at = np.flatnonzero(inner)
            words.append(upto[at] - 1)  # the borders before a word number it
            g = h[at]
            buckets.append(((g ^ (g >> np.uint64(31))) * _M1 >> np.uint64(47)).astype(np.int64) & (BUCKETS - 1))
        b = np.flatnonzero(border)
        length = np.diff(b) - 1
        if (length > 0).any():  # the word as a whole; its last sign is the border behind it
            first = b[:-1][length > 0] + 1
            place = np.arange(len(c)) - np.repeat(b, np.append(np.diff(b), 1))
            h = np.add.reduceat((c * _PLACES[place % len(_PLACES)])[:b[-1] + 1], first)
            words.append(upto[first] - 1)
            buckets.append(((h ^ (h >> np.uint64(29))) * _M2 >> np.uint64(47)).astype(np.int64) & (BUCKETS - 1))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return np.concatenate(words), np.concatenate(buckets), int(upto[-1])


def _parts(text: str, size: int = 1 << 20) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        end = text.rfind(" ", at + size // 2, at + size)
        end = end if end >= 0 else at + size
        yield text[at:end]
        for _ in range(WINDOW):  # back by a window of words
            back = text.rfind(" ", at + size // 4, end)
            end = back if back >= 0 else end
        at = end
    yield text[at:]


@dataclass
class Model:
    """One weight per n-gram bucket, a bias, and the line that maps logits to scores."""

    weights: np.ndarray
    bias: float
    cut: float
    slope: float

    def logit(self, text: str) -> float | None:
        """Of the strongest window; very long texts are gone through in parts that overlap by a window."""
        found = [z for part in _parts(text) if (z := self._strongest(part)) is not None]
        return max(found, default=None)

    def _strongest(self, text: str) -> float | None:
        word, bucket, n = ngrams(text)
        if not len(word):
            return None
        sums = np.bincount(word, self.weights[bucket], n)
        counts = np.bincount(word, minlength=n)
        sums, counts = sums[counts > 0], counts[counts > 0]
        s, k = np.cumsum(np.append(0.0, sums)), np.cumsum(np.append(0, counts))
        first = np.arange(max(1, len(sums) - WINDOW + 1))
        last = np.minimum(first + WINDOW, len(sums))
        return float(((s[last] - s[first]) / (k[last] - k[first])).max() + self.bias)

    def score(self, text: str | None) -> float:
        """From 0 to 1; texts without a word get 0."""
        z = self.logit(text) if text else None
        if z is None:
            return 0.0
        x = np.clip(self.slope * (z - self.cut) + np.log(CUT / (1 - CUT)), -700, 700)
        return float(1 / (1 + np.exp(-x)))


# ---------------------------------------------------------------- training

class _Windows:
    """The windows of the sample over its distinct words, with the sums that training needs."""

    def __init__(self, texts: list[str]):
        ids: dict[str, int] = {}
        rows, doc = [], []
        for d, text in enumerate(texts):
            own = np.array([ids.setdefault(w, len(ids)) for w in _WORDS.findall(text.lower())], np.int32)
            if len(own):
                at = np.arange(0, max(1, len(own) - WINDOW + STRIDE), STRIDE)[:, None] + np.arange(WINDOW)
                rows.append(np.append(own, np.int32(-1))[np.minimum(at, len(own))])
                doc.append(np.full(len(at), d, np.int32))
        self.words = np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.int32)
        self.doc = np.concatenate(doc) if doc else np.zeros(0, np.int32)
        word, bucket, n = ngrams(" ".join(ids))
        order = np.argsort(word, kind="stable")
        self.word, self.bucket = word[order], bucket[order]
        self.vocabulary = len(ids)
        counts = np.bincount(self.word, minlength=self.vocabulary)
        # n-grams of very few texts of the sample say more about those texts than about words
        texts_of = np.bincount(np.unique(np.stack([np.repeat(self.doc, WINDOW), self.words.reshape(-1)]), axis=1)[1] + 1,
                               minlength=self.vocabulary + 1)[1:]
        common = np.bincount(self.bucket, texts_of[self.word], BUCKETS) >= MIN_TEXTS
        self.word, self.bucket = self.word[common[self.bucket]], self.bucket[common[self.bucket]]
        counts = np.append(counts, 0)
        self.size = sum(counts[self.words[:, k]] for k in range(WINDOW)).clip(1)

    def word_sums(self, table: np.ndarray) -> np.ndarray:
        """Per distinct word the sum of its n-grams' vectors, and a row of zeros for the missing word."""
        out = np.zeros((self.vocabulary + 1, table.shape[1]))
        for k in range(table.shape[1]):
            out[:-1, k] = np.bincount(self.word, table[self.bucket, k], self.vocabulary)
        return out

    def averages(self, sums: np.ndarray, of: np.ndarray) -> np.ndarray:
        words = self.words[of]
        out = sums[words[:, 0]]
        for k in range(1, WINDOW):
            out += sums[words[:, k]]
        return out / self.size[of, None]


def _step(w: _Windows, of: np.ndarray, target: np.ndarray, weight: np.ndarray, state: dict) -> None:
    """One full-batch Adam step on the chosen windows."""
    sums = w.word_sums(state["table"])
    x = w.averages(sums, of)
    z = x @ state["out"] + state["bias"]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(of)), target] -= 1
    p *= weight[:, None]
    grads = {"out": x.T @ p, "bias": p.sum(axis=0)}
    dx = (p @ state["out"].T) / w.size[of, None]
    flat = w.words[of].reshape(-1)
    table = np.empty_like(state["table"])
    for k in range(table.shape[1]):
        per_word = np.bincount(flat + 1, np.repeat(dx[:, k], WINDOW), w.vocabulary + 1)[1:]
        table[:, k] = np.bincount(w.bucket, per_word[w.word], BUCKETS)
    grads["table"] = table
    state["t"] += 1
    for name, g in grads.items():
        m, v = state["m"][name], state["v"][name]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        state[name] -= RATE * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.999 ** state["t"])) + 1e-8)


def train(texts: list[str], toxic: np.ndarray, negative_weight: float = 1.0) -> Model:
    """A model from labelled texts; ``negative_weight`` undoes the thinning of the clean ones for the cut.

    A third of the texts of either class is kept out of training and places the cut where
    their F1 is best. Without texts of both classes the model scores 0.5 for
    every text with a word.
    """
    toxic = np.asarray(toxic, bool)
    part = np.where(toxic, np.cumsum(toxic), np.cumsum(~toxic)) % 3 != 0  # two thirds of either class
    if not (toxic & part).any() or not (~toxic & part).any():
        return Model(np.zeros(BUCKETS), 0.0, float(np.log(CUT / (1 - CUT))), 1.0)
    w = _Windows([t for t, p in zip(texts, part, strict=True) if p])
    label = toxic[part].astype(np.int64)
    rng = np.random.default_rng(SEED)
    state = {"table": rng.normal(0, 0.1, (BUCKETS, DIM)), "out": rng.normal(0, 0.1, (DIM, 2)), "bias": np.zeros(2), "t": 0}
    state["m"] = {k: np.zeros_like(state[k]) for k in ("table", "out", "bias")}
    state["v"] = {k: np.zeros_like(state[k]) for k in ("table", "out", "bias")}
    every = np.arange(len(w.doc))
    per_doc = np.bincount(w.doc, minlength=len(label)).clip(1)
    share = 1 / np.array([max(1, (label == 0).sum()), max(1, (label == 1).sum())])
    of, target = every, label[w.doc]
    weight = share[target] / per_doc[w.doc]
    for turn, epochs in enumerate(ROUNDS):
        for _ in range(epochs):
            _step(w, of, target, weight, state)
        if turn == len(ROUNDS) - 1:
            break
        z = w.averages(w.word_sums(state["table"]), every) @ (state["out"][:, 1] - state["out"][:, 0])
        order = np.lexsort((-z, w.doc))  # strongest windows of each text first
        rank = np.empty(len(order), np.int64)
        start = np.searchsorted(w.doc[order], np.arange(len(label)))
        rank[order] = np.arange(len(order)) - start[w.doc[order]]
        # a toxic text needs one strong window; a clean one may have none, however many it has
        strong, clean = (label[w.doc] == 1) & (rank < 1), label[w.doc] == 0
        of = np.flatnonzero(strong | clean)
        target = label[w.doc[of]]
        weight = np.where(target == 1, share[1], share[0] * np.where(rank[of] < 2, 0.35, 0.3 / per_doc[w.doc[of]]))
    d = state["out"][:, 1] - state["out"][:, 0]
    model = Model(state["table"] @ d, float(state["bias"][1] - state["bias"][0]), 0.0, 1.0)
    return _with_cut(model, [t for t, p in zip(texts, part, strict=True) if not p], toxic[~part], negative_weight)


def _with_cut(model: Model, texts: list[str], toxic: np.ndarray, negative_weight: float) -> Model:
    z = np.array([-np.inf if (x := model.logit(t)) is None else x for t in texts])
    fine = np.isfinite(z)
    z, toxic = z[fine], toxic[fine]
    if not toxic.any():
        model.cut = float(np.log(CUT / (1 - CUT)))  # nothing to place the cut by: the softmax itself
        return model
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(toxic[order])
    false = np.cumsum(~toxic[order]) * negative_weight
    f1 = 2 * hits / (hits + false + max(1, toxic.sum()))
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    sorted_z = np.append(z[order], z.min() - 1)
    # between the last text called toxic and the next one
    model.cut = float(np.mean([(sorted_z[best[0]] + sorted_z[best[0] + 1]) / 2, (sorted_z[best[-1]] + sorted_z[best[-1] + 1]) / 2]))
    model.slope = float(4 / max(1e-6, z.std()))
    return model


# ---------------------------------------------------------------- on tables

def held_out(doc_id: Column) -> Column:
    """A third of the ids, never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE,
        max_chars: int = SAMPLE_CHARS) -> Model:
    """Train on at most ``sample`` labelled texts of each class, the first by a hash of their ids.

    Held-out ids, null ids and null labels are left out; of several labels
    of one id the greatest counts. At most ``2 * sample`` texts of at most
    ``max_chars`` characters reach the driver.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sized = docs.select(F.col(key).cast("long").alias("id"), F.length(text).alias("n"))
    known = known.join(sized.filter((F.col("n") > 0) & (F.col("n") <= max_chars)).select("id").distinct(),
                       F.col("doc_id") == F.col("id"), "left_semi")
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        few = (known.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
               .select(F.col("doc_id").alias("chosen_id"), "toxic"))
        chosen = few if chosen is None else chosen.unionByName(few)
    rows = (docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
            .filter((F.length("t") > 0) & (F.length("t") <= max_chars))
            .join(F.broadcast(chosen), F.col("id") == F.col("chosen_id"))  # 2 * sample ids at most
            .groupBy("id").agg(F.min("t").alias("t"), F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("id"), "id").collect())
    toxic = np.array([r["toxic"] == 1 for r in rows], bool)
    thinning = max(1, totals.get(0, 0)) / max(1, int((~toxic).sum())) / (max(1, totals.get(1, 0)) / max(1, int(toxic.sum())))
    return train([r["t"] for r in rows], toxic, thinning)


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` per document, over the whole text, in one pass without a shuffle.

    Null, empty and wordless texts score 0. A null key isn't held out.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "score"])
    scored = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text)).mapInArrow(
        run, "doc_id long, held_out boolean, score double")
    return scored.select(F.col("doc_id").alias(key), "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))
