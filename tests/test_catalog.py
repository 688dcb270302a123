"""Driver contract: entry(), every registered query against its SQL oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog as C
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["term", "n"] and len(rows) > 0


def test_every_query_has_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = set(C.QUERIES) - set(C.ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = [dcols.index(c) for c in cols]
    want = [tuple(r[i] for i in order) for r in want]
    assert sorted(got, key=repr) == sorted(want, key=repr)
