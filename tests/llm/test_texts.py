import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from frames import awkward_docs, no_docs, words
from pyspark.sql import functions as F

from tessera.llm import main_text, private_data, quality, toxicity

# ---------------------------------------------------------------- quality rules


def base_figures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_figures_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, t) for i, (_, t, _, _) in enumerate(awkward_docs(spark, long_words=2000)[1])]
    for i in range(60):
        w = words(rng, rng.randint(1, 12))
        rows.append((100 + i, rng.choice(["\n", " ", "\t|", "  "]).join(rng.choices(w, k=rng.randint(1, 80))) + "#%"))
    df = quality.figures(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"], "f")
    got = {r.doc_id: (r.f.n_words, r.f.word_chars, r.f.n_symbols, r.f.n_dup_lines, r.f.n_repeat_words) for r in df.collect()}
    assert got == {i: base_figures(t) for i, t in rows}


def test_binomial_tail_is_exact(spark):
    rows = [(n, k) for n in (1, 5, 9, 40, 300, 5000) for k in (0, 1, 2, 3, 40) if k <= n]
    df = spark.createDataFrame(rows, "n long, k long")
    for p in (0.01, 0.05):
        for r in df.withColumn("tail", quality.binomial_tail(F.col("k"), F.col("n"), p)).collect():
            q = Fraction(str(p))
            exact = float(sum(math.comb(r.n, j) * q**j * (1 - q)**(r.n - j) for j in range(r.k + 1)))
            assert r.tail == pytest.approx(exact if r.k < r.n * p else 1.0, rel=1e-8)
        # few terms: the rest is covered by a geometric series from above
        for r in df.withColumn("tail", quality.binomial_tail(F.col("k"), F.col("n"), p, terms=2)).filter("k < n * 0.005").collect():
            q = Fraction(str(p))
            exact = float(sum(math.comb(r.n, j) * q**j * (1 - q)**(r.n - j) for j in range(r.k + 1)))
            assert exact * (1 - 1e-9) <= r.tail <= 2 * exact


def _labelled(spark, n=4000):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        w = words(rng, 40)
        docs.append((i, " ".join(x + ("%%%" if bad else "") for x in w), "en" if i % 4 else "de", 1, "x"))
        labels.append((i, 0 if bad else 1, 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, n_words long, stratum string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_rules_reject_junk_within_their_risk(spark):
    docs, labels = _labelled(spark)
    out = quality.quality_report(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, out))
    assert share[0] < 0.01 and share[1] > 1 - quality.RISK
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_without_evidence_only_the_base_rule_rejects(spark):
    docs, labels = _labelled(spark, 60)
    for known in (labels, labels.limit(0)):
        got = quality.quality_report(docs, known).collect()
        assert all(r.kept and not r.base_failed for r in got)


def test_copies_and_base_failures_are_no_evidence(spark):
    """600 copies of one good text, or 600 good texts that the base rule rejects, certify nothing."""
    rng = random.Random(6)
    text = " ".join(words(rng, 60))
    junk = " ".join(w + "###$$$" for w in words(rng, 30))  # no word repeats: the base rule takes it
    for good in ([text] * 600, [" ".join(words(rng, 10)) for _ in range(600)]):
        docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*good, junk])], "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
        got = {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}
        assert got[600].kept and not got[600].base_failed
    different = [" ".join(words(rng, 60)) for _ in range(900)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*different, junk])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(900)], "doc_id long, quality int, toxic int")
    assert not {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}[900].kept


def test_awkward_texts_are_judged(spark):
    docs, rows = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 1), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_report(docs, labels).collect()
    want = Counter((i, *base_figures(t), (b := base_figures(t))[0] < 20 or 100 * b[4] > 30 * b[0]) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(r.kept != r.base_failed for r in got)
    assert quality.quality_report(no_docs(spark), labels).collect() == []


# ---------------------------------------------------------------- personal data

_PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    def fine(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "card":
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in double) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15
    return [(k, *m.span()) for k, p in _PLAIN.items() for m in re.finditer(p, text or "") if fine(k, m[0])]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    parts = [*"ab1234@.@.-_ +()", "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (974) 555-3436", "4532015112830366"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert private_data.plain_spans(text) == plain(text), text


@pytest.mark.parametrize("text, kind, found", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("john at example dot com", "email", "john at example dot com"),
    ("ok jоhn@example.cоm ok", "email", "jоhn@example.cоm"),
    ("jo​hn@ex.com", "email", "jo​hn@ex.com"),
    ("plus one nine seven four five five five three four three six", "phone", "plus one nine seven four five five five three four three six"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("4lll 1111 1111 1111", "card", "4lll 1111 1111 1111"),
    ("ip 192[.]168[.]1[.]10 x", "ip", "192[.]168[.]1[.]10"),
    ("ip 192 dot 168 dot 1 dot 10.", "ip", "192 dot 168 dot 1 dot 10"),
    ("call nine seven four five five five one two one two now", "phone", "nine seven four five five five one two one two"),
    ("john_at_example_dot_com", "email", "john_at_example_dot_com"),
    ("to john @ example.com", "email", "john @ example.com"),
    ("john&#64;example&period;com", "email", "john&#64;example&period;com"),
    ("card 4111.1111.1111.1111", "card", "4111.1111.1111.1111"),
])
def test_disguises_are_found_at_their_place(text, kind, found):
    _, every = private_data.spans(text)
    assert (kind, found) in [(k, text[a:b]) for k, a, b in every]
    assert found not in private_data.redacted(text)


@pytest.mark.parametrize("text", ["look at example.com today", "one two three", "one two three four five six seven eight nine", "one-at-a-time, state_of_the_art", "un un un un un un un un un", "he waited at the door. nine of five came", "", "a" * 1000])
def test_ordinary_texts_are_left_alone(text):
    assert private_data.spans(text) == ([], []) and private_data.redacted(text) == text


@pytest.mark.parametrize("text", ["john  at   example  dot  com", "john\tat\texample\tdot\tcom", "john at\nexample dot com",
                                  "john\nat example\ndot com", "john.doe  at  example.com", "j1\tat\texample.com"])
def test_worded_addresses_over_other_gaps(text):
    assert private_data.spans(f"mail {text}, please")[1] == [("email", 5, 5 + len(text))]
    assert private_data.redacted(f"mail {text}, please") == "mail [EMAIL], please"
    assert private_data.spans("look  at\nexample.com or a dot\non it")[1] == []


@pytest.mark.parametrize("text", [
    "But at some point we have to stop.", "We arrived at this point in time.", "They were at one point 3 goals ahead",
    "He was at the point of leaving", "the score stood at that point after the break", "look at this dot com bubble",
    "At what point do we give up?", "She looked at the dot in the middle of the page", "He stared at one dot in particular",
    "At this point de facto control passed on", "at every point to the north of it", "It was at the lowest point ever measured",
    "at that point it was over", "Start at any point and go on", "Meet me at the point at noon", "we are at a point of no return",
    "at boiling point water turns to steam", "The line ends at point be or point se", "Aim at the red dot and press",
    "at a point io and back", "They met at high point de luxe", "I was at match point twice", "sold at the dot com peak",
    "He worked at a dot com for years", "people at dot com firms", "the price at one point de facto doubled",
    "Look at each dot on the map", "at the turning point es began to fall", "stand at the vantage point to see it",
    "They are good at dot to dot puzzles", "We stopped at every point fr om here", "at knife point he gave in",
    "Wir waren am Punkt der Entscheidung", "Der Punkt ist at den Rand gesetzt", "An diesem Punkt de facto vorbei",
    "Sie kam auf den Punkt und ging", "Punkt eins und Punkt zwei sind klar", "ein Punkt in der Mitte at all",
    "Der wunde Punkt de lege ferenda", "Punkt fünf Uhr war Schluss", "Kommen wir zum Punkt com o",
    "À ce point de la route, on tourne", "Il est sur le point de partir", "un point de vue at large",
    "Le point fr est une revue", "Au point où nous en sommes", "point par point, il répond", "mettre au point de nouveaux outils",
    "En ese punto de la historia", "El punto es que no hay tiempo", "a tal punto de no volver", "desde mi punto de vista at home",
    "punto com o punto es lo mismo", "punto y aparte", "hasta cierto punto de acuerdo", "llegó en punto es decir a tiempo",
])
def test_prose_about_points_and_dots_is_left_alone(text):
    assert private_data.spans(text) == ([], []) and private_data.redacted(text) == text


@pytest.mark.parametrize("text", [
    "maria.weber at firma punkt de", "jean arobase exemple point fr", "ana arroba ejemplo punto es", "first dot last at mail dot example dot org",
    "john [at] example point com", "jo@example dot net", "j_99 at example.com",
])
def test_worded_addresses_in_four_languages(text):
    assert private_data.redacted(f"mail: {text}, please") == "mail: [EMAIL], please"


def test_addresses_stay_linear():
    import time
    for text in ("x dot " * 200_000, "x at " * 200_000, "x at y dot " * 90_000, "a@" * 300_000, "x dot y at " * 90_000,
                 "a" * 500_000 + " at b dot c ", "x at x dot com " * 1000, ("a." * 20 + "b at ") * 20_000):
        began = time.perf_counter()
        list(private_data._addresses(text))
        assert time.perf_counter() - began < (1 if text.startswith("x dot x") else 8), text[:30]
    began = time.perf_counter()
    private_data.spans("x dot " * 200_000)
    assert time.perf_counter() - began < 6


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, " one" * 50_000, "+1" + " " * 300_000, "@" * 100_000, "a@" * 100_000):
        private_data.spans(text)


def test_private_data_on_tables(spark):
    docs, rows = awkward_docs(spark, long_words=2000)
    more = [(50, "x a.b@c.de, 4111 1111 1111 1111!"), (51, "é a@b.c 10.0.0.1 +1 (974) 555-3436")]
    only = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = private_data.op9(only.withColumn("spans", F.lit(1)).withColumn("base", F.lit("x"))).collect()
    assert len(got) == len(rows) + 2
    for i, text in more:
        r = next(r for r in got if r.doc_id == i)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
        assert r.spans == line and r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(line.count(k) for k in private_data.KINDS)
    masked = private_data.redact(docs)
    assert masked.dtypes == docs.dtypes and masked.filter("text IS NULL").count() == sum(t is None for _, t, *_ in rows)
    assert private_data.op9(no_docs(spark)).collect() == [] and private_data.redact(no_docs(spark)).collect() == []


# ---------------------------------------------------------------- toxicity


def test_ngrams_of_words():
    word, bucket, n = toxicity.ngrams("Ab, abc")
    own = Counter(word.tolist())
    assert n >= 2 and own == Counter({0: 4, 1: 7})  # <ab ab> <ab> ab; <ab abc bc> <abc abc> <abc> abc
    assert len(toxicity.ngrams("")[0]) == len(toxicity.ngrams(" ,. ")[0]) == 0
    assert set(bucket[word == 0][:1].tolist()) <= set(bucket[word == 1].tolist())  # <ab is shared


def _toxic_texts(n, seed=4):
    rng = random.Random(seed)
    insults = ["idiot", "moron", "worthless", "pathetic"]
    texts, toxic = [], []
    for i in range(n):
        w = words(rng, rng.randint(5, 150))
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice(insults))
        texts.append(" ".join(w))
        toxic.append(i % 3 == 0)
    return texts, toxic


def test_model_knows_insults_and_their_misspellings():
    texts, toxic = _toxic_texts(900)
    model = toxicity.train(texts, np.array(toxic))
    others, marks = _toxic_texts(300, seed=5)
    called = np.array([model.score(t) >= toxicity.CUT for t in others])
    assert (called == np.array(marks)).mean() > 0.93
    plain_words = " ".join(words(random.Random(6), 60))
    assert model.score(plain_words + " you idiott") > model.score(plain_words)
    assert model.score(None) == model.score("") == model.score(" ,.") == 0.0


def test_a_passage_scores_the_same_wherever_it_stands():
    weights = np.zeros(toxicity.BUCKETS)
    phrase = "six words that belong together here"
    weights[toxicity.ngrams(phrase)[1]] = 1.0
    model = toxicity.Model(weights, 0.0, 0.0, 1.0)
    found = [model.logit(f"{'zzzz ' * k}{phrase}{' zzzz' * 9}") for k in range(7)]
    assert found == [pytest.approx(1.0)] * 7


def test_parts_of_a_long_text_overlap_by_a_window():
    text = " ".join(f"w{i}" for i in range(2000))
    parts = list(toxicity._parts(text, 400))
    assert len(parts) > 20 and set(" ".join(parts).split()) == set(text.split())
    whole = {tuple(text.split()[i:i + toxicity.WINDOW]) for i in range(2000 - toxicity.WINDOW + 1)}
    seen = {tuple(w[i:i + toxicity.WINDOW]) for p in parts for w in [p.split()] for i in range(len(w) - toxicity.WINDOW + 1)}
    assert whole == seen and "".join(toxicity._parts("a" * 1000, 100)) == "a" * 1000


def test_toxicity_on_tables(spark):
    docs, rows = awkward_docs(spark, long_words=2000)
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (3, 1, None), (77, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.op8(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert toxicity.op8(docs, labels.limit(0)).count() == len(rows) and toxicity.op8(no_docs(spark), labels).collect() == []


def test_held_out_labels_are_never_learned_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, weight: seen.append(texts) or toxicity.Model(np.zeros(toxicity.BUCKETS), 0, 0, 1))
    rows = [(i, f"text of {i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))
    import zlib
    assert sorted(seen[0]) == sorted(t for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1)


# ---------------------------------------------------------------- main text


def test_blocks_of_a_page():
    page = ('<html><head><title>x</title></head><body class="has-sidebar"><header>Site</header><div id="top-menu">m</div><main><article>'
            '<header><h1>T &amp; t</h1></header><p>One<b> two</b><br>three<p>Four &lt;x&gt; <a href="a>b">link</a><ul><li>i1<li>i2</ul>'
            '<div class="share">S</div><section class="comments"><p>c</p></section></article></main><aside>q</aside><form>f</form>'
            '<script>var t = "</p>";</script><!-- <p>no</p> --></body></html>')
    assert [t for _, t in main_text.page_blocks(page)[0]] == ["T & t", "One two three", "Four <x> link", "i1", "i2"]
    assert main_text.page_blocks(None) == main_text.page_blocks("") == ([], [])
    assert [t for _, t in main_text.page_blocks("plain \n text")[0]] == ["plain text"]
    assert [t for _, t in main_text.page_blocks('<div class="content sidebar"><p>all there is</p></div>')[0]] == ["all there is"]
    assert [t for _, t in main_text.page_blocks("a < b <p>c&nbsp; d<!-- open")[0]] == ["a < b", "c d"]


@pytest.mark.parametrize("page, want", [
    ('<body><form id="aspnetForm"><div class="menu">m</div><article><h1>T</h1><p>the text</p><form>f</form></article></form></body>',
     ["T", "the text"]),
    ("<body><nav><ul><li>m<article><p>the text</p></article></body>", ["the text"]),
    ("<body><header><h1>Site</h1><main><p>the text</p><aside>q</aside></main>", ["the text"]),
    ('<div style="display:none"><article><p>the text</p></article></div><div>by h</div>', ["the text"]),
    ('<main style="display: none"><p>the text</p></main><div>by h</div>', ["the text"]),
    ("<html><head><title>x</title><body><p>the text</p>", ["the text"]),
    ("<body><header>Site<div><p>the text</p></div>", ["Site", "the text"]),
    ("<form><p>the text</p><template>n</template></form>", ["the text"]),
    # what marks an article elsewhere stays out
    ("<article><p>the text</p><aside><article>another text to read</article></aside></article>", ["the text"]),
    ("<main><p>the text</p></main><aside><article>more</article></aside>", ["the text"]),
    ("<div><p>the long text</p></div><aside><article>more</article></aside>", ["the long text", "more"]),
    ('<article><p>the text</p></article><section><article class="comment">a longer comment</article></section>', ["the text"]),
])
def test_articles_below_what_is_never_one(page, want):
    assert [t for _, t in main_text.page_blocks(page)[0]] == want


@pytest.mark.parametrize("page, want", [
    ('<div class="content no-sidebar"><p>the article</p></div><div class="end">Made by h</div>', ["the article", "Made by h"]),
    ('<div class="content">the article</div><div class="ad-free">a</div><div class="post share-enabled">b</div>', ["the article", "a", "b"]),
    ('<div class="col page-has-sidebar">a</div><div class="content">the article</div>', ["a", "the article"]),
    ('<div id="search-results"><p>the whole article</p><div class="share">S</div></div><div>by h</div>', ["the whole article", "by h"]),
    ('<div class="notice wrap"><div class="menu">m</div><div class="widget"><p>the article itself</p></div></div>', ["the article itself"]),
    ('<article><p>one</p><section class="related-work"><p>most of the article</p></section></article>', ["one", "most of the article"]),
    ('<body><span class="notice">the whole of a long article in a single span</span><p>b', ["the whole of a long article in a single span", "b"]),
    ('<div class="discussion"><p>a long thread of posts, all there is here</p></div><i>h</i>', ["a long thread of posts, all there is here", "h"]),
    ('<article class="commentary"><p>the article</p></article><div>by h</div>', ["the article"]),
    # names still take what is small, and replies that are long
    ('<div>the article is here</div><div class="related-work">more</div><div class="sidebar">s</div>', ["the article is here"]),
    ('<div>the article</div><div class="comments"><p>a longer comment than the article</p></div>', ["the article"]),
    ('<article>the article<div class="widget">w</div><article class="comment">longer than it</article></article>', ["the article"]),
])
def test_names_are_no_more_than_a_prior(page, want):
    assert [t for _, t in main_text.page_blocks(page)[0]] == want


def test_branches_common_to_a_host_go(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(60):
        host = "one.example" if i < 40 else f"h{i}.example"
        body = [" ".join(words(rng, 12)) for _ in range(rng.randint(1, 5))]
        shared = ["a passage that many pages share"] if i % 4 == 0 else []
        page = (f'<body><div class="box"><p>Welcome to {host}</p><p>All rights</p></div><div class="text">'
                + "".join(f"<p>{b}</p>" for b in body + shared) + f'</div><div class="end">Made by {host}</div></body>')
        rows.append((i, f"https://{host}/{i}", page, "x", "y"))
        template = [] if i < 40 else [f"Welcome to {host}", "All rights"]
        want[i] = "\n".join(template + body + shared + ([] if i < 40 else [f"Made by {host}"]))
    # copies of one page don't make it a template
    rows += [(100 + i, f"https://copies.example/{i}", "<body><div><p>the same text</p><p>again</p></div></body>", "x", "y") for i in range(30)]
    want |= {100 + i: "the same text\nagain" for i in range(30)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, blocks string")
    got = {r.page_id: (r.text, r.n_chars) for r in main_text.op4(df).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_awkward_pages(spark):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (2, "https://x", None), (3, "", ""), (None, "//x/y", "<p>&eacute;&#x1F642;</p>"),
            (4, "https://x", "<p>" + "long " * 50_000), (5, "https://x", "<" * 2000), (6, "https://x", "<div>" * 3000 + "deep")]
    got = main_text.op4(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 8 and by[2].text == by[3].text == "" and by[None].text == "é🙂" and by[None].n_chars == 2
    assert by[4].n_chars == 249_999 and by[6].text == "deep" and sum(r.page_id == 1 and r.text == "a" for r in got) == 2
    assert main_text.op4(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
