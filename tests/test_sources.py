import gzip
import json
import os
import tempfile

from tessera.operators import itemsets as its
from tessera.sources import readers, sinks, storage


def test_conditions_csv_by_header(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    path = os.path.join(d, "conditions.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write("START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n")
        f.write("2020-01-01,,p1,e1,c1,Cough\n2020-01-02,,p1,e2,c2,Fever\n2020-01-03,,p2,e3,c1,Cough\n")
    df = readers.read_conditions_csv(spark, path)
    assert df.columns == ["PATIENT", "CODE", "DESCRIPTION"]
    b = its.basket_distinct(df, "PATIENT", "CODE")
    assert b.count() == 3


def test_json_lines_documents(spark):
    d = tempfile.mkdtemp(prefix="tessera-json-")
    path = os.path.join(d, "news.json")
    with open(path, "w") as f:
        for i, t in enumerate(["first post text", "second post"]):
            f.write(json.dumps({"text": t, "tweet_id": str(100 + i), "url": "u"}) + "\n")
    df = readers.read_documents_json(spark, path)
    assert sorted(df.columns) == ["text", "tweet_id"] and df.count() == 2


def test_sinks_and_materialize(spark):
    d = tempfile.mkdtemp(prefix="tessera-sink-")
    top = spark.createDataFrame([(1, "a", "b", "A", "B", 5)],
                                "rank long, item_1 string, item_2 string, description_1 string, "
                                "description_2 string, support long")
    sinks.write_top_itemsets_tsv(top, os.path.join(d, "top"), "pair")
    text = "".join(open(os.path.join(d, "top", f)).read() for f in sorted(os.listdir(os.path.join(d, "top")))
                   if f.endswith(".csv"))
    assert text.splitlines() == ["pair\tcount", "['A', 'B']\t5"]
    lines = spark.createDataFrame([("{A} -> {B}: 1",)], "line string")
    sinks.write_rule_lines(lines, os.path.join(d, "rules"))
    sinks.write_parquet(top, os.path.join(d, "pq"))
    assert spark.read.parquet(os.path.join(d, "pq")).count() == 1
    m = storage.materialize(top, "t")
    assert m._tessera_rows == 1 and storage.row_count(m) == 1
    root = storage.checkpoint_root(spark).split(":", 1)[-1].lstrip("/")
    assert root in m.inputFiles()[0]


def test_release_deletes_materialized_folder(spark):
    df = storage.materialize(spark.range(5), "to_release")
    folder = df.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[-1]
    folder = "/" + folder.lstrip("/")
    assert os.path.isdir(folder)
    storage.release(df)
    assert not os.path.exists(folder)


def test_conditions_csv_in_any_column_order(spark, tmp_path):
    import bz2

    path = tmp_path / "conditions.csv.bz2"
    with bz2.open(path, "wt") as f:
        f.write("SYSTEM,CODE,PATIENT,DESCRIPTION,START\nsnomed,c1,p1,Cough,2020-01-01\nsnomed,c2,p1,Fever,2020-01-02\n")
    rows = readers.read_conditions_csv(spark, str(path)).orderBy("CODE").collect()
    assert [tuple(r) for r in rows] == [("p1", "c1", "Cough"), ("p1", "c2", "Fever")]


def test_json_ids_keep_their_type(spark, tmp_path):
    import bz2

    path = tmp_path / "news.json.bz2"
    with bz2.open(path, "wt") as f:
        for i in (10, 9):
            f.write(json.dumps({"text": f"post {i}", "tweet_id": i, "url": "u"}) + "\n")
    df = readers.read_documents_json(spark, str(path))
    assert [r.tweet_id for r in df.orderBy("tweet_id").collect()] == [9, 10]
    as_text = readers.read_documents_json(spark, str(path), readers.TWEETS_SCHEMA)
    assert dict(as_text.dtypes)["tweet_id"] == "string"


def test_checkpoint_folder_is_named_by_the_launcher(spark):
    from types import SimpleNamespace

    import pytest

    unset = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://x"),
                            conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError):
        storage.checkpoint_root(unset)


def test_broken_csv_lines_are_rejected(spark, tmp_path):
    path = tmp_path / "rows.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write('id,name,n\n1,one,10\n2,two\n3,"three, and ""more""",30\n4,four,40,extra\n5,,\n6,six,sixty\n\n7,seven,70\n')
    got = readers.load_csv(spark, str(path), {"id": "bigint", "n": "int"})
    assert sorted(map(tuple, got.good.collect())) == [(1, "one", 10), (3, 'three, and "more"', 30), (5, None, None), (7, "seven", 70)]
    assert sorted(r.line for r in got.rejected.collect()) == ["2,two", "4,four,40,extra", "6,six,sixty"]
    assert (got.n_good, got.n_rejected) == (4, 3)
    assert all(r.file.endswith("rows.csv.gz") for r in got.rejected.collect())
    assert got.good.select("name").count() == 4      # pruned columns change nothing
    got.release()


def test_csv_quotes_over_lines(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('id,name\n1,"a\nb"\n2,plain\n')
    got = readers.load_csv(spark, str(path), multi_line=True)
    assert sorted(map(tuple, got.good.collect())) == [("1", "a\nb"), ("2", "plain")] and got.n_rejected == 0
    single = readers.load_csv(spark, str(path))
    assert [tuple(r) for r in single.good.collect() if r.id == "2"] == [("2", "plain")]
    assert single.n_rejected >= 1


def test_csv_of_a_header_alone(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("id,name\n")
    got = readers.load_csv(spark, str(path))
    assert got.good.columns == ["id", "name"] and (got.n_good, got.n_rejected) == (0, 0)


def test_broken_json_lines_are_rejected(spark, tmp_path):
    import bz2

    path = tmp_path / "rows.json.bz2"
    with bz2.open(path, "wt") as f:
        f.write('{"id": 1, "text": "one", "more": [1]}\n{"id": 2, "text"\n\n{"text": "no id"}\nnothing\n{"id": "x", "text": "t"}\n')
    schema = spark.createDataFrame([], "id long, text string").schema
    got = readers.load_json(spark, str(path), schema)
    assert sorted(map(tuple, got.good.collect()), key=str) == [(1, "one"), (None, "no id")]
    assert sorted(r.line for r in got.rejected.collect()) == sorted(["nothing", '{"id": "x", "text": "t"}', '{"id": 2, "text"'])
    assert (got.n_good, got.n_rejected) == (2, 3)


def test_ordered_files_are_read_back_in_order(spark, tmp_path):
    rows = [(i, f"line {i * 7919 % 5000:05d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, line string").repartition(6)
    want = sorted(line for _, line in rows)
    for kind, options in (("text", {}), ("parquet", {"compression": "gzip"}), ("json", {"compression": "bzip2"})):
        path = str(tmp_path / kind)
        lines = df.select("line")
        manifest = sinks.write_ordered(lines, ["line"], path, kind, options).orderBy("part").collect()
        assert len(manifest) >= 1 and sum(r.rows for r in manifest) == 5000 and manifest[0].first_rank == 1
        assert all(a.first_rank + a.rows == b.first_rank for a, b in zip(manifest, manifest[1:]))
        back = sorted((r["rank"], r.line) for r in sinks.read_ordered(spark, path, kind, lines.schema, options).collect())
        assert back == list(enumerate(want, 1))


def test_ordered_files_of_several_splits(spark, tmp_path):
    """A file read by several tasks keeps its order."""
    df = spark.createDataFrame([(f"{i:06d}" + "x" * 50,) for i in range(20_000)], "line string").coalesce(1)
    path = str(tmp_path / "big")
    sinks.write_ordered(df, ["line"], path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = sinks.read_ordered(spark, path, "text", df.schema).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in sorted(rows, key=lambda r: r["rank"])] == sorted(r.line for r in rows) and len(rows) == 20_000
    assert sorted(r["rank"] for r in rows) == list(range(1, 20_001))


def test_ordered_write_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "line string")
    assert sinks.write_ordered(df, ["line"], str(tmp_path / "none")).agg({"rows": "sum"}).first()[0] in (None, 0)
    assert sinks.read_ordered(spark, str(tmp_path / "none"), "text", df.schema).count() == 0
