"""The queries that have SQL, against DuckDB on the smallest tables."""

import glob
import os

import pytest

from strandloom.llm import queries
from tests.test_oracles import DIR, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    con = pytest.importorskip("duckdb").connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = queries.queries()[name](spark, DIR), con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
