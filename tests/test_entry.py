import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import registry
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns[0] == "rank"


def test_every_query_has_oracle_sql():
    # the training-data queries have tests of their own
    own = set(registry.all_queries())
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql())


def _norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    sdf = entry.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    want = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want
