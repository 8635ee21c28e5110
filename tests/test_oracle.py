"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E

TABLES = ["customer", "part", "orders", "lineitem", "events", "documents", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v if v is None or isinstance(v, (bool, int, str)) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = Counter(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in sorted(cols)]
    want = Counter(tuple(norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "content" in df.columns


def test_every_query_registered_runs(spark):
    missing = [q for q in E.oracle_sql() if q not in E.queries()]
    assert not missing
