"""The prefix trie against a plain one, however its rows are dealt."""

import hashlib
import random
import zlib

import pytest

from sentimart.llm import trie as T

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode())
            turns.setdefault(conv, []).append(((turn is not None, turn or 0, digest.digest()), (role, text)))
    turns = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)          # the remainder has c's sign
        rebuilt[c] = tuple(turns.get(base, [])[:h]) + tuple(own[h:])
    nodes = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, convs in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(nodes[p]) - 1) * len([w for w in p[-1][1].split()] if p else []) for p in below)
        ends = ",".join(str(c) for c in sorted(c for c in convs if rebuilt[c] == path))
        out.append((min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), len(kids), len(leaves),
                    saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(-25, n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a b", "a", "", None, "c d e"])))
    return rows + [(10**6 + c, t, "user", f"same {t}") for c in range(40) for t in range(4)]


EDGES = [(7, None, None, None), (7, None, "user", "x y"), (7, 1, "user", "x"), (7, 1, "user", "x"), (None, 0, "user", "lost"),
         (8, 0, "user", "  \n "), (21, 0, "user", "alone"), (400, 5, "a", "b"), (400, -5, "a", "first"),
         *[(440, t, "user", f"turn {t % 3}") for t in range(60)]]


@pytest.mark.parametrize("limits,parts", [({}, 8), ({"shard_members": 3, "band": 4, "queue": 2}, 3),
                                          ({"shard_members": 1, "band": 7, "queue": 1}, 37)])
def test_equals_plain_trie(spark, limits, parts):
    rows = some_rows(60, 1) + EDGES
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))      # conversations cross range partitions
    try:
        out = T.rebuilt_trie(spark.createDataFrame(rows, TURNS).selectExpr("*", "0 as depth", "0 as node"), **limits)
        got = sorted((tuple(r) for r in out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                   "saved_tokens", "ends_sha256").collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain(rows)


def test_empty_table(spark):
    assert T.rebuilt_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert T.rebuilt_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_ids_of_a_hot_end_are_digested_in_pieces(spark, monkeypatch):
    rows = [(20 * c, 0, "user", "same") for c in range(30_000)]       # about 180 KB of ids
    got = {r["depth"]: r for r in T.rebuilt_trie(spark.createDataFrame(rows, TURNS).repartition(3)).collect()}
    ids = ",".join(str(c) for c, *_ in rows)
    assert got[1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest() and got[1]["n_convs"] == 30_000
    assert got[0]["ends_sha256"] == hashlib.sha256(b"").hexdigest() and len(got) == 2


def test_queue_spills_and_keeps_order():
    rng = random.Random(2)
    messages = [(rng.randrange(-9, 0), bytes([rng.randrange(256)] * 16), i, -i) for i in range(500)]
    queue = T.Queue(limit=7)
    for m in messages:
        queue.push(m)
    assert queue.spilled > 50
    got = []
    for key in sorted({m[:2] for m in messages}):
        got += [(*key, *rest) for rest in queue.take(key)]
    assert sorted(got) == sorted(messages) and not queue
    queue.push((-3, bytes(16), 1, 1))
    with pytest.raises(ValueError):
        list(queue.take((-2, bytes(16))))
