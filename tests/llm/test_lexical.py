"""Ranked lexical search against a plain computation, and its pruning."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sentimart.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    counted = [(doc_id, terms(text)) for doc_id, text in docs]
    counted = [(d, len(w), Counter(w)) for d, w in counted if w]
    n_docs, length = len(counted), sum(n for _, n, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    out = set()
    for item, text in set(items):
        found = []
        for d, n, tf in counted:
            m = 75 + 25 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in terms(text) if t in tf)
            if score > 0 and d is not None and item is not None:
                found.append((-score, d))
        out |= {(item, text, i, d, -s) for i, (s, d) in enumerate(sorted(found)[:k], 1)}
    return sorted((i, r, d, s) for i, _, r, d, s in out)


def some_texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Étude", "naïve", "a1b2", "ß"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 10, 40]))) for _ in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"_SHARD": 7, "_BLOCK": 2, "_CELLS": 50}, {"GROUP_BYTES": 100}])
def test_equals_plain_scores(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(X, name, value)
    docs = list(enumerate(some_texts(150, 1))) + [(5, "w1 w2"), (5, "w1 w2"), (None, "w3 w3 Étude"), (900, None), (901, ""),
                                                  (902, "... --"), (903, "w7 " * 30_000)]
    items = list(enumerate(some_texts(12, 2))) + [(0, "w1 W1 w1"), (3, None), (4, " "), (None, "w1"), (50, "unknown words")]
    got = X.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                           spark.createDataFrame(items + items[:3], "item_id long, text string"), k=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(docs, [x for x in items if x[0] is not None and x[1] is not None], 4)


def test_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "copied1 copied2")], "item_id long, text string")
    assert X.rank_documents(edge_docs, none).count() == 0 and X.rank_documents(no_docs, one).count() == 0
    # repeated rows are documents each; the row without an id is no result
    assert [r["doc_id"] for r in X.rank_documents(edge_docs, one).orderBy("rank").collect()] == [5, 5, 6, 7]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(X, "_PIECE", 10)
    text = "One,twoTHREE four5 " * 20 + "x" * 100 + "Ünder_score"
    assert [t.decode() for part in X.terms_of(text.encode()) for t in part] == terms(text)


def test_blocks_are_left_out_and_nothing_is_lost():
    rng = np.random.default_rng(3)
    terms_ = {f"t{i}".encode(): i for i in range(300)}
    # a hundred kinds of documents, each twenty times with other impacts
    kinds = [np.unique(rng.integers(0, 300, 25)) for _ in range(100)]
    docs = [kinds[i % 100] for i in range(2_000)]
    items = X.Items([0, 1], terms_, [(docs[8], np.ones(len(docs[8]), dtype=int)), (docs[5], np.ones(len(docs[5]), dtype=int))])
    weights = rng.integers(1, 5_000, 300)
    search = X.Search(X._block(items, [0, 1], np.arange(300), weights), 5)
    impacts = [rng.integers(400_000, 600_000, len(d)) for d in docs]
    for at in range(0, 2_000, 500):
        some = slice(at, at + 500)
        search.add(np.arange(at, at + 500), np.array([len(d) for d in docs[some]]), np.concatenate(docs[some]),
                   np.concatenate(impacts[some]))
    for i, (numbers, counts) in enumerate(items.of):
        value = dict(zip(numbers.tolist(), (counts * weights[numbers]).tolist()))
        scores = sorted((-sum(value.get(t, 0) * v for t, v in zip(d.tolist(), imp.tolist())), n)
                        for n, (d, imp) in enumerate(zip(docs, impacts)))[:5]
        assert [(-s, n) for s, n in zip(search.scores[i].tolist(), search.ids[i].tolist())] == scores
    assert search.skipped > 0.3 * search.bounded
