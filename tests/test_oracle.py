"""Every registered query that has SQL gives the same rows as DuckDB at the smallest scale."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

from varicube.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def value(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(catalog.oracle_sql()[name])
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    want = sorted((tuple(value(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0
