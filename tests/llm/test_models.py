"""Held-out quality of the trained models, and the forward sums."""

import itertools

import numpy as np
import pytest

from sentimart.llm import language_id as L
from sentimart.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_forward_sums_every_segmentation():
    pieces = L.Pieces(sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "ba"]))
    rng = np.random.default_rng(0)
    probability = rng.random((len(pieces.pieces), 2))
    value = dict(zip(pieces.pieces, probability))
    for word in ("▁abab", "▁ba", "ab", "▁abz"):
        want = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, at = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(word[at:i])
                    at = i
            parts.append(word[at:])
            factors = [value.get(p, L._FLOOR if len(p) == 1 else 0.0) for p in parts]
            want += np.prod([np.broadcast_to(f, 2) for f in factors], axis=0)
        got = L._Lattice(pieces, probability, [word], np.array([len(word)])).total[0]
        assert got == pytest.approx(want)


def test_expected_uses_add_up():
    pieces = L.Pieces(sorted(["▁", "▁a", "a", "b", "ab"]))
    probability = np.full((5, 1), 0.2)
    lattice = L._Lattice(pieces, probability, ["▁aab", "▁b"], np.array([4, 2]))
    uses = lattice.expected(np.array([[1.0], [2.0]]))[:, 0]
    letters = sum(u * len(p) for u, p in zip(uses, pieces.pieces))
    assert letters == pytest.approx(4 + 2 * 2)


def test_whole_vocabulary_is_loaded():
    pieces = L.load_pieces()
    assert {"▁information", "▁government", "translation"} <= set(pieces.pieces)
    assert pieces.longest == max(map(len, pieces.pieces)) == 16


def long_words():
    rng = np.random.default_rng(4)
    return ["".join(rng.choice(list("abz"), size=n)) for n in (3, 24, 25, 26, 40, 60, 61, 300, 2_000)]


@pytest.mark.parametrize("cells", [1 << 17, 70])
def test_long_words_sum_every_segmentation(monkeypatch, cells):
    # few cells: words are swept in stretches
    monkeypatch.setattr(L, "_CELLS", cells)
    pieces = L.Pieces(sorted(["▁a", "a", "b", "ab", "▁ab", "ba", "abbaabba", "aaaaaaaaaaaaa"]))
    rng = np.random.default_rng(0)
    probability = rng.random((len(pieces.pieces), 2)) / 20
    value = dict(zip(pieces.pieces, probability))
    words = [*long_words(), "a" * 50]
    got = L._log_likelihoods(pieces, L.Model(["x", "y"], np.ones(2) / 2, probability), words)
    for word, logs in zip(words, got):
        word = "▁" + word
        sums, scale = [np.ones(2)], np.zeros(2)
        for j in range(1, len(word) + 1):
            total = np.zeros(2)
            for i in range(max(0, j - pieces.longest), j):
                total += sums[i] * value.get(word[i:j], L._FLOOR if j - i == 1 else 0.0)
            sums = [s / total for s in sums] + [np.ones(2)]
            sums[:max(0, j - pieces.longest)] = [np.zeros(2)] * max(0, j - pieces.longest)
            scale += np.log(total)
        assert logs == pytest.approx(scale)


@pytest.mark.parametrize("cells", [1 << 17, 70])
def test_long_words_expected_uses(monkeypatch, cells):
    monkeypatch.setattr(L, "_CELLS", cells)
    pieces = L.Pieces(sorted(["▁a", "▁b", "▁z", "▁", "a", "b", "z", "ab", "ba", "abbaabba", "aaaaaaaaaaaaa"]))
    probability = np.random.default_rng(1).random((len(pieces.pieces), 2))
    words = ["▁" + w for w in long_words()[:4]]
    counts = np.array([[1.0, 2.0], [3.0, 0.0], [1.0, 1.0], [0.0, 4.0]])
    short = L._Lattice(pieces, probability, words, np.array([len(w) for w in words])).expected(counts)
    assert L._Sweep(pieces, probability, words).expected(counts) == pytest.approx(short)
    long = ["▁" + w for w in long_words()[4:]]
    uses = sum(L._Sweep(pieces, probability, [long[i] for i in of]).expected(np.ones((len(of), 2)))
               for of in L._long_batches(long))
    letters = uses.T @ np.array([len(p) for p in pieces.pieces])
    assert letters == pytest.approx(sum(map(len, long)))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op7_language_id"](spark, SF).filter("held_out").join(docs, "doc_id").toPandas()
    assert len(found) > 1_000 and (found.lang == found.lang_pred).mean() > 0.97


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op4_toxicity"](spark, SF).filter("held_out").join(labels, "doc_id").toPandas()
    toxic, clean = found[found.toxic == 1], found[found.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 1).mean() < 0.03


def test_toxicity_risk_gradient():
    """Each step goes down the non-negative risk: its gradient against
    differences of the risk itself, and the whole fit against a plain one."""
    from sentimart.llm import toxicity as X
    rng = np.random.default_rng(2)
    n, prior = 400, 0.2
    positive = np.arange(n) < 100
    texts = [np.unique(np.concatenate([rng.integers(0, 60, 6), rng.integers(60, 70, 3) if (p or rng.random() < 0.15) else []]))
             .astype(int) for p in positive]
    words, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    model = X.fit(words, sizes, positive, prior)
    x = np.zeros((n, X.FEATURES), dtype=bool)
    x[np.repeat(np.arange(n), sizes), words] = True
    used = np.flatnonzero(model.weights)
    dense = x[:, used].astype(float)

    def parts(w):
        z = dense @ w[:-1] + w[-1]
        plus, minus = np.logaddexp(0, -z[positive]).mean(), np.logaddexp(0, z[positive]).mean()
        return prior * plus, np.logaddexp(0, z[~positive]).mean() - prior * minus

    def risk(w):
        plus, negative = parts(w)
        return (plus + negative if negative >= 0 else -negative) + X._DECAY * (w[:-1] ** 2).sum() / 2
    w = np.append(np.zeros(len(used)), np.log(prior / (1 - prior)))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, X._STEPS + 1):
        g = np.array([(risk(w + h) - risk(w - h)) / 2e-6 for h in np.eye(len(w)) * 1e-6])
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= X._RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    assert len(used) >= 5
    assert model.weights[used] == pytest.approx(w[:-1], abs=0.02) and model.bias == pytest.approx(w[-1], abs=0.02)
