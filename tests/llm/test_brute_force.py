"""Operators against brute force on small random tables."""

import random

import numpy as np
import pytest
import xxhash

from sentimart.llm.components import components
from sentimart.llm.line_dedup import dedup_lines
from sentimart.llm.simhash import fingerprint, links, simhash_groups
from sentimart.llm.substring_dedup import dedup_word_windows
from sentimart.llm.suffix_array import common_prefixes, suffix_array
from sentimart.llm.suffix_dedup import dedup_byte_windows
from sentimart.llm.url_filter import Automaton, glob


def random_texts(seed, n=60, words=("a", "bb", "ccc", "ß", "d\n", "e")):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(12)]
    return [(i, " ".join(rng.choices(pool, k=rng.randint(0, 3)))) for i in rng.sample(range(1_000), n)]


def covered_runs(kind, rows, length):
    """By document: kept symbols and their number, by comparing all windows."""
    seen, out = {}, {}
    for doc, text in sorted(rows):
        symbols = text.split() if kind == "words" else list(text.encode())
        hit = [False] * len(symbols)
        own = []
        for at in range(len(symbols) - length + 1):
            window = tuple(symbols[at:at + length])
            earlier = window in seen if kind == "bytes" else seen.get(window, doc) < doc
            if earlier:
                hit[at:at + length] = [True] * length
            elif kind == "bytes":
                seen[window] = doc
            own.append(window)
        for window in own:
            seen.setdefault(window, doc)
        out[doc] = (len(symbols), sum(hit), [s for s, h in zip(symbols, hit) if not h])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows(spark, seed):
    rows = random_texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = covered_runs("words", rows, 8)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"].split())
           for r in dedup_word_windows(docs, length=8, k=3, cells=1 << 16).collect()}
    assert got == want and any(v[1] for v in want.values())


@pytest.mark.parametrize("seed,shard", [(3, 1 << 20), (4, 0)])
def test_byte_windows(spark, monkeypatch, seed, shard):
    # shards of no size: every anchor takes the path of very common ones
    monkeypatch.setattr("sentimart.llm.suffix_dedup.SHARD_BYTES", shard or 1)
    rows = random_texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = covered_runs("bytes", rows, 20)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], list(r["kept"]))
           for r in dedup_byte_windows(docs, length=20, k=7, cells=1 << 16).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_suffix_arrays():
    rng = np.random.default_rng(7)
    for _ in range(150):
        n_symbols = int(rng.integers(2, 6))
        s = np.append(rng.integers(1, n_symbols, int(rng.integers(1, 80))), 0).astype(np.uint16)
        order = suffix_array(s, n_symbols)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        shared = common_prefixes(s, order)
        for a, b in zip(order[:-1], order[1:]):
            left, right = s[a:].tolist(), s[b:].tolist()
            assert shared[b] == next((i for i, (x, y) in enumerate(zip(left, right)) if x != y), min(len(left), len(right)))


def test_fingerprint():
    words = "One two  TWO three\tfour".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(3)]
    bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 3)
    assert fingerprint("One two  TWO three\tfour".encode(), 3) == bits
    assert fingerprint(b"Two words", 3) == xxhash.xxh64_intdigest(b"two words", 42)
    assert fingerprint(b" \n", 3) == 0


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_links(spark, max_bits):
    rng = random.Random(max_bits)
    values = {rng.getrandbits(64) for _ in range(30)}
    for v in list(values):
        values |= {v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, max_bits + 2))) for _ in range(6)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(r) for r in links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), max_bits).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits}
    assert got == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_simhash_component_is_smallest_id(spark):
    text = " ".join(f"w{i}" for i in range(400))
    near = text.replace("w200 ", "other ")
    docs = spark.createDataFrame([(9, text), (3, near), (7, text), (1, "something else entirely")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash_groups(docs).collect()}
    bits = (fingerprint(text.encode(), 3) ^ fingerprint(near.encode(), 3)).bit_count()
    assert got[1] == 1 and got[9] == got[7] == (3 if bits <= 3 else 7)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(20, 40))).strip().ljust(20, "x") for _ in range(12)]

    def mutated(line):
        line = list(line)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(line))
            kind = rng.randrange(3)
            line[at:at + (kind != 0)] = [] if kind == 2 else [rng.choice("abcdé")]
        return "".join(line)
    rows = [(i, "\n".join([*(mutated(rng.choice(pool)) for _ in range(rng.randint(0, 5))), "short"])) for i in range(60)]
    seen, want = [], {}
    for doc, text in rows:
        gone = 0
        for line in text.split("\n"):
            line = line.strip(" ")
            if len(line) >= 20:
                gone += any(edits(line, other) <= 1 for other in seen)
                seen.append(line)
        want[doc] = gone
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["document"]["doc_id"]: r["n_removed"] for r in dedup_lines(docs, cells=1 << 16).collect()}
    assert got == want and sum(want.values()) > 30


def test_automaton_is_glob():
    import re
    rng = random.Random(3)
    globs = ["".join(rng.choices(["a", "b", "/", "*", "**"], k=rng.randint(1, 40))) for _ in range(25)]
    texts = [bytes(rng.choices(b"ab/", k=rng.randint(0, 40))) for _ in range(300)]
    found = Automaton([glob(g) for g in globs]).matches(texts)
    for i, g in enumerate(globs):
        parts = re.split(r"(\*+)", g)
        # a run of stars is one wildcard, the widest of what it holds
        pattern = "".join("" if not p else ("[^/]*" if p == "*" else ".*") if p[0] == "*" else re.escape(p) for p in parts)
        want = [re.fullmatch(pattern, t.decode()) is not None for t in texts]
        assert found[:, i].tolist() == want, g


@pytest.mark.parametrize("n_letters", [1, 2, 4, 26])
def test_suffix_array_recurses_to_a_sorted_order(monkeypatch, n_letters):
    from sentimart.llm import suffix_array as S
    rng = np.random.default_rng(n_letters)
    phrase = rng.integers(1, n_letters + 1, 700)
    text = np.concatenate([phrase, phrase[:300], rng.integers(1, n_letters + 1, 900), phrase, [0]]).astype(np.uint16)
    levels, inner = [], S.suffix_array

    def traced(s, n_symbols):
        levels.append((len(s), n_symbols))
        return inner(s, n_symbols)
    monkeypatch.setattr(S, "suffix_array", traced)
    values = text.tolist()
    want = sorted(range(len(values)), key=lambda i: values[i:])
    for bucket in (0, 32, 10**9):                      # both kinds of sweep at every level
        levels.clear()
        monkeypatch.setattr(S, "_LARGE_BUCKET", bucket)
        assert traced(text, n_letters + 1).tolist() == want
        assert len(levels) > 2 or n_letters == 1
        assert all(b[0] <= a[0] / 2 for a, b in zip(levels, levels[1:]))
