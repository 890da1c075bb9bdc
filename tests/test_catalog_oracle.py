"""Every catalog query against its DuckDB SQL on the smallest test tables."""

import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SLOW = {"rf_cross_validated"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("test tables not available")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    assert _rows(srows, scols) == _rows(res.fetchall(), dcols)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_non_sql_queries_run(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("test tables not available")
    assert E.queries()[name](spark, SF).count() >= 1


def test_every_sql_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not available")
    df = E.entry(spark)
    assert df.columns == ["airport_id", "latitude_deg", "longitude_deg", "flight_count"]
    assert df.count() > 0
