"""Every core query with SQL against DuckDB on the smallest test data, where it is there."""

import glob
import os

import pytest

from frameloom.plans.queries import oracle_sql, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    found = duck.execute(oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
