from collections import Counter

import corpus_pipeline
from frames import awkward_docs
from test_dedup import brute_components, text_set
from test_texts import base_figures

from tessera.llm import private_data, registry
from tessera.llm.oracle import all_sql

SF001 = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs, rows = awkward_docs(spark, long_words=1500)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", "size", "kept")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = dict(corpus_pipeline.STAGES)
    good = at["quality_rules"](spark, docs, str(tmp_path))
    assert good.dtypes == docs.dtypes
    fine = {i: t for i, t, *_ in rows if (f := base_figures(t))[0] >= 20 and 100 * f[4] <= 30 * f[0]}
    assert {r.doc_id for r in good.collect()} == set(fine)
    single = at["near_duplicates"](spark, good, str(tmp_path))
    comps = brute_components({i: text_set(t, 5) for i, t in fine.items() if i is not None})
    assert single.dtypes == docs.dtypes
    left = [r for r in single.collect() if r.doc_id is not None]
    assert sorted(r.doc_id for r in left) == sorted(i for i, c in comps.items() if i == c)
    clean = at["personal_data"](spark, single, str(tmp_path))
    assert clean.dtypes == docs.dtypes
    assert {r.doc_id: r.text for r in clean.collect()} == {r.doc_id: private_data.redacted(r.text) for r in single.collect()}
    mixed = at["source_mixing"](spark, clean, str(tmp_path))
    assert mixed.dtypes == docs.dtypes and max(Counter(r.doc_id for r in mixed.collect() if r.doc_id is not None).values()) <= 3
    packed = at["packing"](spark, mixed, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in mixed.collect())


def test_run_is_its_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    strip = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert strip(docs) == strip(corpus_pipeline.run(spark, SF001))


def test_every_operator_is_registered():
    names = list(registry.all_queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and set(all_sql()) <= set(names)


def test_queries_equal_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    for name, sql in all_sql().items():
        df = registry.all_queries()[name](spark, SF001)
        rel = con.execute(sql)
        columns = [c[0] for c in rel.description]
        assert sorted(columns) == sorted(df.columns)
        want = Counter(rel.fetchall())
        assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want
