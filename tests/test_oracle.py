"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver does the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from sentimart import catalog
from tools.oracle_check import rows_key

from paths import SF_SMALL

# the training-data queries have their own tests, in tests/llm
catalog.load_all()
QUERIES = {k: f for k, f in E.queries().items() if k in catalog.QUERIES}
ORACLE = {k: f for k, f in E.oracle_sql().items() if k in catalog.QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert rows_key(df.columns, rows) == rows_key(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rank" in df.columns and "topic" in df.columns
