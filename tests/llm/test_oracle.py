"""Corpus queries against their SQL in DuckDB."""

import duckdb
import pytest

from riskweave.llm.oracle import STATEMENTS
from riskweave.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for view in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    wanted = con.execute(STATEMENTS[name])
    columns = [d[0] for d in wanted.description]
    found = QUERIES[name](spark, sf_dir).select(columns).collect()
    assert sorted(map(tuple, found)) == sorted(wanted.fetchall())
