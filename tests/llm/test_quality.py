"""The quality classifier: held-out accuracy, its densities, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentimart.llm import quality as Q
from sentimart.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op13_quality"](spark, SF).filter("held_out").join(labels, "doc_id").toPandas()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    assert len(good) > 500 and len(bad) > 80
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.95


def test_log_odds_are_density_differences():
    rng = np.random.default_rng(5)
    d = Q._DIM
    classes = [rng.standard_normal((400, d)) @ rng.standard_normal((d, d)) / 4, rng.standard_normal((900, d))]
    n = np.array([400.0, 900.0])
    first, second = np.array([x.sum(axis=0) for x in classes]), np.array([x.T @ x for x in classes])
    model = Q.fit(n, first, second, np.zeros(d), np.ones(d), 0.3, 0.1)
    own = [np.cov(x.T, bias=True) for x in classes]
    common = (400 * own[0] + 900 * own[1]) / 1_300
    x, want = rng.standard_normal((7, d)), []
    for k in (0, 1):
        mixed = 0.7 * own[k] + 0.3 * common
        mixed = 0.9 * mixed + 0.1 * np.diag(np.diagonal(mixed)) + 1e-4 * np.eye(d)
        off = x - classes[k].mean(axis=0)
        want.append(np.log((n[k] + 1) / 1_302) - 0.5 * np.linalg.slogdet(mixed)[1]
                    - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(mixed), off))
    assert model.log_odds(x) == pytest.approx(want[1] - want[0])


def test_moments_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(1, 5)), int(rng.integers(2)), rng.standard_normal(Q._DIM).tolist()) for _ in range(200)]
    df = spark.createDataFrame(rows, "fold int, label int, x array<double>")
    x = np.array([r[2] for r in rows])
    for parts in (1, 7):
        n, first, second = Q._summed(df.repartition(parts), 5)
        assert n.sum() == 200 and first.sum(axis=(0, 1)) == pytest.approx(x.sum(axis=0))
        assert second.sum(axis=(0, 1)) == pytest.approx(x.T @ x)


def test_statistics_count_what_they_say():
    text = "One TWO two.\nOne TWO two.\n  ### 12 !!\n".encode()
    s = dict(zip(Q.STATISTICS, Q.statistics(text)))
    share = lambda a, b: np.arcsin(np.sqrt(a / b))
    assert s["words"] == pytest.approx(np.log1p(9))
    assert s["upper_words"] == pytest.approx(share(2, 9)) and s["letterless_words"] == pytest.approx(share(3, 9))
    assert s["repeated_lines"] == pytest.approx(share(1, 3)) and s["ended_lines"] == pytest.approx(share(3, 3))
    assert s["distinct_words"] == pytest.approx(share(6, 9)) and s["repeated_triples"] == pytest.approx(share(1, 7))
    assert not Q.statistics(b"").any() and not Q.statistics(b" \n\t").any()
    assert np.isfinite(Q.statistics("é".encode() * 3_000_000)).all()


def test_pieces_are_cut_after_white_space(monkeypatch):
    monkeypatch.setattr(Q, "_PIECE", 11)
    text = b"some words of a text " + b"x" * 40 + b"\nend"
    assert b"".join(Q._cut(text)) == text and all(len(p) <= 11 for p in Q._cut(text))


def test_edges(spark, edge_docs, no_docs):
    marks = spark.createDataFrame([(2, 1), (2, 0), (4, 1), (5, 1), (6, 0), (7, 0), (9, 1), (10, 0), (99, 1), (3, None),
                                   (None, 1)], "doc_id long, quality int")
    out = Q.score_quality(edge_docs, marks).collect()
    assert len(out) == 13 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in out) and "domain" in out[0]["document"].asDict()
    of = {r["document"]["text"]: r["score"] for r in out}
    assert of[None] == of[""]
    one_class = Q.score_quality(edge_docs, marks.withColumn("quality", F.lit(1)))
    assert {r["score"] for r in one_class.collect()} == {0.5}
    assert Q.score_quality(no_docs, marks).count() == 0
