"""Every query with SQL gives what DuckDB makes of the SQL, on the smallest tables."""

import glob
import os

import pytest

from strandloom.plans import catalog

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x

    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DIR)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, DIR).count() >= 0
