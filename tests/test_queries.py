"""Every registered query against its check SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from trackflow.catalog.proxies import TABLES
from trackflow.catalog.registered import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_its_check(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    result = duck.execute(CHECKS[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == names
    want = sorted((tuple(r[order.index(c)] for c in names) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 13


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)
