"""Every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from pluvia.plans import catalog
from pluvia.plans.fixtures import TABLES
from tests.plan_rules import check_plan_rules
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    # Bit-for-bit: every double compared by its full repr.
    assert digest(sdf.columns, srows, exact=True)[0] == digest(dcols, drows, exact=True)[0]
    # Scale rules on the plan that just ran (final, post-AQE).
    check_plan_rules(name, sdf._jdf.queryExecution().executedPlan().toString())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "most_common_weather" in df.columns
