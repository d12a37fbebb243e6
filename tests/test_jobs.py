import os
import tempfile

from pyspark.sql import functions as F

from tessera.plans import catalog
from tessera.plans.jobs import market_basket_job, near_duplicate_job

from conftest import SF001


def test_market_basket_job_writes_all_outputs(spark):
    out = tempfile.mkdtemp(prefix="tessera-mb-")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    part = spark.read.parquet(f"{SF001}/part.parquet")
    events = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand", "p_name")
    res = market_basket_job(events, out, "l_orderkey", "p_brand", "p_name", min_support=8, min_std_lift=0.0)
    for name in ("frequent_k1", "frequent_k2", "frequent_k3", "most_frequent_k2", "most_frequent_k3",
                 "association_rules"):
        assert os.path.isdir(os.path.join(out, name))
    k2 = spark.read.parquet(os.path.join(out, "frequent_k2"))
    assert k2.count() == res.levels[2].count()
    assert k2.filter(F.size("items") != 2).count() == 0
    assert spark.read.text(os.path.join(out, "association_rules")).count() == res.rules.count()


def test_near_duplicate_job_writes_all_outputs(spark):
    out = tempfile.mkdtemp(prefix="tessera-nd-")
    docs = catalog.documents(spark, SF001)
    query = docs.select("doc_id").limit(20)
    res = near_duplicate_job(docs, out, similar_to=query, fpfn_fraction=0.5, fpfn_rounds=2)
    assert spark.read.parquet(os.path.join(out, "similar_pairs")).count() == res.similar_pairs.count()
    assert spark.read.parquet(os.path.join(out, "minhash")).count() == docs.filter(F.length("text") >= 9).count()
    assert spark.read.parquet(os.path.join(out, "fpfn_rounds")).count() == 2
    assert spark.read.parquet(os.path.join(out, "fpfn_summary")).first().rounds == 2


def test_command_line_runs_both_jobs(spark):
    import gzip
    import json

    from tessera.__main__ import main

    d = tempfile.mkdtemp(prefix="tessera-cli-")
    csv = os.path.join(d, "conditions.csv.gz")
    with gzip.open(csv, "wt") as f:
        f.write("START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n")
        for p in range(6):
            for code, desc in (("c1", "Cough"), ("c2", "Fever"), ("c3", "Rash")):
                if p % 3 != 0 or code != "c3":
                    f.write(f"2020-01-01,,p{p},e{p},{code},{desc}\n")
    assert main(["market-basket", csv, "--out", os.path.join(d, "mb"), "-s", "2", "-l", "0"]) == 0
    assert spark.read.parquet(os.path.join(d, "mb", "frequent_k2")).count() == 3
    news = os.path.join(d, "news.json")
    with open(news, "w") as f:
        for i, t in enumerate(["the quick brown fox jumps over the lazy dog"] * 2 + ["something else entirely here"]):
            f.write(json.dumps({"text": t, "tweet_id": f"t{i}", "url": "u"}) + "\n")
    assert main(["near-duplicates", news, "--out", os.path.join(d, "nd"), "--similar-to", "t0",
                 "--fpfn-analysis", "--fpfn-analysis-fraction", "0.99"]) == 0
    pairs = spark.read.parquet(os.path.join(d, "nd", "similar_pairs")).collect()
    assert [(r.first, r.second, r.similarity) for r in pairs] == [("t0", "t1", 1.0)]
    assert [r.similar_id for r in spark.read.parquet(os.path.join(d, "nd", "similar_to")).collect()] == ["t1"]


def test_jobs_read_back_what_was_finished(spark, tmp_path, monkeypatch):
    from tessera.plans import jobs
    from tessera.sources.store import ResultStore

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    part = spark.read.parquet(f"{SF001}/part.parquet")
    docs = catalog.documents(spark, SF001)
    run = lambda n: (
        market_basket_job(li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand"), str(tmp_path / f"mb{n}"),
                          "l_orderkey", "p_brand", min_support=8, reuse=ResultStore(spark, str(tmp_path / "reuse"))),
        near_duplicate_job(docs, str(tmp_path / f"nd{n}"), reuse=ResultStore(spark, str(tmp_path / "reuse"))))
    rows = lambda df: sorted(map(str, df.collect()))
    basket, near = run(1)
    for name in ("mine_itemsets", "find_near_duplicates"):
        monkeypatch.setattr(jobs, name, None)      # nothing may be computed again
    basket_2, near_2 = run(2)
    assert basket.n_baskets == basket_2.n_baskets
    for a, b in ((basket.levels[2], basket_2.levels[2]), (basket.levels[3], basket_2.levels[3]), (basket.rules, basket_2.rules),
                 (near.signatures, near_2.signatures), (near.similar_pairs, near_2.similar_pairs)):
        assert rows(a) == rows(b)
