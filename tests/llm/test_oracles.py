"""The queries with SQL against DuckDB on whole tables."""

import duckdb
import pytest

from pluvia.llm.queries import ORACLE, QUERIES
from pluvia.plans.fixtures import TABLES
from tools.oracle_check import digest


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, name, sf):
    con, folder = duckdb.connect(), f"/root/testdata/{sf}"
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in got.collect()]
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(got.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(got.columns, rows, exact=True)[0] == digest(columns, want, exact=True)[0]
