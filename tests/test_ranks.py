"""Rank selection against a plain sort: ties, NULLs, hot keys, bounds."""

import random

import pytest
from pyspark.sql import functions as F

from sentimart.operators.ranks import rank_slice


def key(row):
    return [(v is not None, v) for v in row]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "", "a", "ab", "é", "z"]), rng.choice([None, -1, 0, 7]), i) for i in range(400)]
    rows += [("hot", 5, 1_000 + i) for i in range(300)] + [("hot", 6, 9)] * 200          # equal altogether
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("start,stop", [(0, 10), (0, 1), (395, 405), (450, 520), (600, 900), (880, 950), (200, 200), (900, 2_000),
                                        (0, 2_000), (5_000, 5_001)])
@pytest.mark.parametrize("small,splitters", [(4, 3), (100, 7)])
def test_equals_a_plain_sort(spark, rows, start, stop, small, splitters):
    df = spark.createDataFrame(rows, "name string, n long, id long").repartition(3)
    got = sorted((r["ordinal"], r["name"], r["n"], r["id"]) for r in
                 rank_slice(df, ["name", "n", "id"], start, stop, small=small, splitters=splitters).collect())
    want = sorted(rows, key=key)
    assert got == [(i, *r) for i, r in enumerate(want)][start:stop]


def test_ties_are_ranked_once_each(spark, rows):
    df = spark.createDataFrame(rows, "name string, n long, id long")
    got = [rank_slice(df.repartition(p), ["name"], a, a + 100, small=10, splitters=3).select("ordinal", "id", "n").collect()
           for p in (1, 5) for a in (500, 600)]
    assert [sorted(map(str, r)) for r in got[:2]] == [sorted(map(str, r)) for r in got[2:]]     # however they are dealt
    ordinals = [r["ordinal"] for part in got[:2] for r in part]
    assert sorted(ordinals) == list(range(500, 700))


def test_neither_sorts_nor_shuffles_the_payload(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"), F.repeat(F.lit("x"), 50).alias("payload")).write.parquet(path)
    out = rank_slice(spark.read.parquet(path), ["k"], 9_000, 9_050, small=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Scan parquet") == 1
    assert "GreaterThanOrEqual(k" in plan and "LessThanOrEqual(k" in plan       # pushed to the scan
    assert sorted((r["ordinal"], r["k"]) for r in out.collect()) == [(i, i) for i in range(9_000, 9_050)]
