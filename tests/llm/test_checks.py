"""Registered queries of this subpackage against their check SQL, and the registry itself."""

import duckdb
import pytest

import __spark_entry__ as entry
from trackflow.llm.registered import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_its_check(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    result = con.execute(CHECKS[name])
    order = [d[0] for d in result.description]
    want = [tuple(r[order.index(c)] for c in names) for r in result.fetchall()]
    assert sorted(order) == names
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_every_operator_is_registered():
    names = entry.queries()
    assert set(CHECKS) <= set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_url_filter_stays_in_the_jvm(spark):
    plan = QUERIES["op4_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
