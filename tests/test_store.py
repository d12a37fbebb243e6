"""Finished results are read back, everything else is built again."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources.store import MARKER, ResultStore, input_fingerprint


@pytest.fixture
def given(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).withColumn("v", F.col("id") % 3).write.parquet(path)
    return path


def store_of(spark, tmp_path):
    return ResultStore(spark, str(tmp_path / "results"))


class Built:
    """Counts how often it is asked to compute."""

    def __init__(self, df):
        self.df, self.times = df, 0

    def __call__(self):
        self.times += 1
        return self.df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_rerun_reads(spark, tmp_path, given):
    df = spark.read.parquet(given)
    built = Built(df)
    first = store_of(spark, tmp_path).get("count", {"s": 1}, [df], built)
    # a restarted driver: a new store over the same folder
    second = store_of(spark, tmp_path).get("count", {"s": 1}, [spark.read.parquet(given)], built)
    assert built.times == 1 and rows(first) == rows(second) == [(0, 4), (1, 3), (2, 3)]
    assert second._tessera_rows == 3 and second.schema == first.schema
    assert rows(store_of(spark, tmp_path).find("count", {"s": 1}, [df])) == rows(first)


def test_parameters_and_operator_are_part_of_the_address(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)
    built = Built(df)
    for operator, params in (("count", {"s": 1}), ("count", {"s": 2}), ("other", {"s": 1}), ("count", {"s": 1, "t": None})):
        store.get(operator, params, [df], built)
    assert built.times == 4
    assert store.find("count", {"s": 3}, [df]) is None


def test_a_changed_input_never_meets_an_old_result(spark, tmp_path, given):
    store = store_of(spark, tmp_path)
    before = Built(spark.read.parquet(given))
    store.get("count", {}, [spark.read.parquet(given)], before)
    spark.range(4).withColumn("v", F.col("id") % 3).write.mode("overwrite").parquet(given)
    df = spark.read.parquet(given)
    after = Built(df)
    assert store.find("count", {}, [df]) is None
    assert rows(store.get("count", {}, [df], after)) == [(0, 2), (1, 1), (2, 1)] and after.times == 1
    spark.range(2).withColumn("v", F.lit(7).cast("long")).write.mode("append").parquet(given)  # files added
    df = spark.read.parquet(given)
    assert (7, 2) in rows(store.get("count", {}, [df], Built(df)))


def test_a_half_written_folder_is_not_read(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)
    built = Built(df)
    folder = store.address("count", {}, [df])
    spark.range(99).write.parquet(f"{folder}/data-broken")        # a run that ended before its marker
    os.makedirs(f"{folder}/data-worse/_temporary")
    assert store.find("count", {}, [df]) is None
    assert rows(store.get("count", {}, [df], built)) == [(0, 4), (1, 3), (2, 3)] and built.times == 1
    assert not os.path.exists(f"{folder}/data-broken")            # swept once the address is finished


def test_a_failed_build_leaves_nothing_finished(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)

    def fails():
        return df.select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        store.get("count", {}, [df], fails)
    assert store.find("count", {}, [df]) is None
    assert rows(store.get("count", {}, [df], Built(df))) == [(0, 4), (1, 3), (2, 3)]


def test_the_first_marker_wins(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)

    def late():
        store.get("count", {}, [df], Built(df))       # another driver finishes meanwhile
        return df.select(F.lit(5).alias("v"), F.lit(5).alias("n")).limit(1)
    assert rows(store.get("count", {}, [df], late)) == [(0, 4), (1, 3), (2, 3)]
    folder = store.address("count", {}, [df])
    marker = json.load(open(f"{folder}/{MARKER}"))
    assert [os.path.basename(p) for p in glob.glob(f"{folder}/data-*")] == [marker["data"]]


def test_forgotten_results_are_built_again(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)
    built = Built(df)
    store.get("count", {}, [df], built)
    store.forget("count", {}, [df])
    store.get("count", {}, [df], built)
    assert built.times == 2


def test_empty_results_and_inputs_without_files(spark, tmp_path, given):
    df, store = spark.read.parquet(given), store_of(spark, tmp_path)
    none = store.get("none", {}, [df], lambda: df.filter("id < 0"))
    assert none.count() == 0 and none.columns == ["id", "v"]
    with pytest.raises(ValueError):
        input_fingerprint(spark.range(3))
