"""Common text-to-SQL query shapes run with spark.sql on registered views,
compared with DuckDB on the same parquet files (SURVEY §2.14)."""

import math
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL

SHAPES = {
    "join_group_having": """SELECT c.c_mktsegment, count(*) AS n, sum(o.o_totalprice) AS total
        FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_mktsegment HAVING count(*) > 10""",
    "order_limit": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "in_not_in": """SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3)
        AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "exists": """SELECT c_custkey FROM customer c WHERE EXISTS
        (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""",
    "union": "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0",
    "intersect": "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey = 4",
    "except": "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "like": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' AND p_brand LIKE 'Brand#1%'",
    "scalar_avg": "SELECT c_name FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)",
}


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def views(spark):
    from rewardlake.sources.readers import register_views
    register_views(spark, SF_SMALL, ["customer", "orders", "part"])
    con = duckdb.connect()
    for t in ["customer", "orders", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_shape(spark, views, shape):
    got = Counter(tuple(norm(x) for x in r) for r in spark.sql(SHAPES[shape]).collect())
    want = Counter(tuple(norm(x) for x in r) for r in views.execute(SHAPES[shape]).fetchall())
    assert got == want and sum(got.values()) > 0
