"""Every registered query equals its DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from minutelake.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events",):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and v == int(v):
        return str(int(v))
    return str(v)


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = sorted(tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in sorted(cols)]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stream", "key", "kind", "path"]


def test_every_library_key_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES) <= set(E.queries())
