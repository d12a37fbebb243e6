"""Small tables with the awkward rows: nulls, blanks, very long texts, repeated rows, clashing columns."""

import random

# extra columns that carry names the operators use themselves
EXTRA = ("size long, h string, row long, cid long, kept boolean, n_words long, key string, bucket long, "
         "range int, shard int, t string, rank long, _f string, _row long")
DOCS_DDL = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


def awkward_docs(spark, seed: int = 1, long_words: int = 30_000):
    rng = random.Random(seed)
    base = words(rng, 120)
    near = base[:60] + ["changed"] + base[61:]
    long = " ".join(words(rng, long_words))
    rows = [
        (1, " ".join(base), "en", "b"), (2, " ".join(near), "en", "a"), (3, " ".join(base), None, "b"),
        (3, " ".join(base), None, "b"), (4, None, "en", "a"), (5, "", "de", None), (6, " \n\t ", "en", "a"),
        (7, "one", "en", None), (8, "One", "en", "c"), (9, "two words", "en", "d"), (10, long, "en", "b"),
        (11, "Ünïcode — text, with 🙂 signs. and dots", "fr", "a"), (None, " ".join(near), "en", "a"),
        (None, None, None, None), (12, "line\n" * 40 + "end of the lines", "en", "e"),
        (13, " ".join(base[:12] * 6), "en", "a"), (14, " ".join(words(rng, 40)), "en", "b"),
    ] + [(20 + i, " ".join(words(rng, rng.randint(1, 90))), "en", rng.choice("abc")) for i in range(25)]
    full = [(i, t, lang, s, len(t) if t else None, 1, "x", 2, 3, False, 4, "k", 5, 6, 7, "t", 8, "f", 9)
            for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS_DDL), rows


def no_docs(spark):
    return spark.createDataFrame([], DOCS_DDL)
