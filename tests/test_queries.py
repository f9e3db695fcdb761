"""Every registered query at the smallest scale against its SQL in DuckDB."""

import os

import pytest

from plexus.queries.registry import QUERIES, SQL, load_all
from tools.check import TABLES, plain

SF = "/root/testdata/sf0.001"
load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def tables(duck):
    for t in TABLES:
        duck.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return duck


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*columns).collect())
    if name not in SQL:
        assert got
        return
    tables.execute(SQL[name])
    names = [d[0] for d in tables.description]
    assert sorted(names) == columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert got == sorted(repr([plain(r[i]) for i in order]) for r in tables.fetchall())


def test_contract():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
