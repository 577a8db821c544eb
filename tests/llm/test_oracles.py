"""Registered queries: against DuckDB where they have SQL, and the shape of
the others."""

import importlib.util
import os

import pytest

import __spark_entry__ as E
from sentimart.llm import queries as Q
from tools.oracle_check import rows_key

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    res = duck.execute(Q.ORACLE[name])
    columns, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    assert rows_key(df.columns, got) == rows_key(columns, rows)


def test_registered_once_each():
    numbers = sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in Q.QUERIES
    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLE) <= set(E.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(importlib.util.find_spec("sentimart").origin)
    for folder, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py") and not folder.startswith(os.path.join(root, "llm")):
                assert "llm" not in open(os.path.join(folder, f)).read(), f
