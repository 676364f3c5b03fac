"""Every registered query against its SQL on the smallest tables."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return repr(list(value)) if isinstance(value, (list, tuple)) else repr(value)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, oracle, name):
    df = driver.queries()[name](spark, SF)
    rows = df.collect()
    if name not in driver.oracle_sql():
        assert rows
        return
    result = oracle.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in df.columns) for r in result.fetchall())
    got = sorted(tuple(plain(v) for v in r) for r in rows)
    assert got == want


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
