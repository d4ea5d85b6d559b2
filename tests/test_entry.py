"""Driver contract: entry smoke, registry/oracle pairing, oracle agreement."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.plans.catalog import registry
from starloom.plans.oracle import oracle_queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_tracks > 0
    assert df.columns == ["total_tracks", "unique_artists", "grammy_artists", "total_genres",
                          "avg_popularity"]


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_queries())
    assert set(registry()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    # Floats compared bit-exactly, as a value hash would.
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    mine = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    theirs = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert mine == theirs
