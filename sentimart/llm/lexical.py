"""Ranked lexical search by per-term geometric blocking.

Documents are scored by a BM25-like sum of term weights and integer
impacts.  One scan of the texts stores each document's counts of the terms
that occur in the items; from these the cluster counts document
frequencies.  The stored documents are then indexed shard by shard, inside
tasks: each term's posting list is cluster by cluster (nearest of some of
its own documents, by a random projection of the document vectors), and a
block keeps the coordinatewise maximum of its documents' impacts.  An item
visits its terms' blocks, rarest term first, and leaves one out only when
the inner product with the maximum, an upper bound of every score in it,
is below the score of its k-th document so far.  A task keeps its best k
documents an item from shard to shard; only these are ranked over the
cluster.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import intermediates, stored, text_bytes

#: bytes of items that share the scans and broadcasts
GROUP_BYTES = 8 << 20
#: cells of a dense matrix (items or documents by terms) in a task
_CELLS = 1 << 23
_SHARD = 2_048           # documents indexed at once, at most
_BLOCK = 4               # documents of a block, about: larger ones have looser bounds
_DIMS = 16               # of the projection that clusters documents
_PIECE = 1 << 20
_MERGES = 64             # first ranking: so many parts of an item's candidates

_SEPARATORS = [c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
_TABLE = bytes(32 if c in _SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of about a megabyte: runs of letters,
    digits and non-ASCII characters, with A-Z lower-cased."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + _PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


@dataclass(frozen=True)
class Items:
    """A group of items: the numbers of their terms, and each item's term
    numbers (ascending) with counts."""
    ids: list[int]
    terms: dict[bytes, int]
    of: list[tuple[np.ndarray, np.ndarray]]

    def blocks(self) -> list[tuple[list[int], np.ndarray]]:
        """The items dealt into blocks whose dense matrix stays small: their
        places and their terms."""
        out: list[tuple[list[int], np.ndarray]] = []
        places: list[int] = []
        seen: set[int] = set()
        for i, (numbers, _) in enumerate(self.of):
            more = seen.union(numbers.tolist())
            if places and len(more) * (len(places) + 1) > _CELLS:
                out.append((places, np.array(sorted(seen))))
                places, more = [], set(numbers.tolist())
            places.append(i)
            seen = more
        return out + ([(places, np.array(sorted(seen)))] if places else [])


def _groups(items: DataFrame) -> Iterator[Items]:
    """Items of up to GROUP_BYTES of text together (a longer one: alone);
    rows without an id or a term are left out, repeated rows count once."""
    ids: list[int] = []
    terms: dict[bytes, int] = {}
    of: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for row in items.toLocalIterator():
        text = row["text"].encode()
        if ids and held + len(text) > GROUP_BYTES:
            yield Items(ids, terms, of)
            ids, terms, of, held = [], {}, [], 0
        counts = Counter(t for part in terms_of(text) for t in part)
        if counts:
            numbers = np.array([terms.setdefault(t, len(terms)) for t in counts])
            order = np.argsort(numbers)
            of.append((numbers[order], np.array(list(counts.values()))[order]))
            ids.append(row["item_id"])
            held += len(text)
    if ids:
        yield Items(ids, terms, of)


_VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                      ("counts", pa.list_(pa.int64()))])
_VECTORS_SQL = "doc_id long, n long, terms array<int>, counts array<long>"


def _counted(shared):
    """(doc_id, n, terms, counts) of the documents that have a term: how
    many in all, and those that the items have too."""
    def run(batches):
        number = shared.value.get
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                total, seen = 0, Counter()
                for part in terms_of(text):
                    total += len(part)
                    seen.update(map(number, part))
                if total:
                    seen.pop(None, None)
                    known = sorted(seen)
                    ids.append(doc_id)
                    n.append(total)
                    terms.append(known)
                    counts.append([seen[t] for t in known])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, n, terms, counts), _VECTORS)],
                                             schema=_VECTORS)
    return run


@dataclass(frozen=True)
class _Block:
    """Some items as a dense matrix over their own terms (``columns`` maps
    term numbers to its columns, -1: none)."""
    places: list[int]
    columns: np.ndarray
    values: np.ndarray           # items x terms: count * weight, int64
    own: list[np.ndarray]        # the columns of each item
    lists: list[tuple[int, np.ndarray, np.ndarray]]   # (column, its items, their columns), rarest first
    projection: np.ndarray


def _block(items: Items, places: list[int], terms: np.ndarray, weights: np.ndarray) -> _Block:
    columns = np.full(len(items.terms), -1, dtype=np.int64)
    columns[terms] = np.arange(len(terms))
    values = np.zeros((len(places), len(terms)), dtype=np.int64)
    own = []
    for row, place in enumerate(places):
        numbers, counts = items.of[place]
        at = columns[numbers]
        values[row, at] = counts * weights[numbers]
        own.append(at[values[row, at] > 0])
    having: dict[int, list[int]] = {}
    for row, at in enumerate(own):
        for c in at.tolist():
            having.setdefault(c, []).append(row)
    lists = [(c, np.array(rows), np.unique(np.concatenate([own[r] for r in rows]))) for c, rows in having.items()]
    lists.sort(key=lambda x: (-weights[terms[x[0]]], x[0]))
    random = np.random.default_rng(11).standard_normal((len(terms), _DIMS)).astype(np.float32)
    return _Block(places, columns, values, own, lists, random * weights[terms, None].astype(np.float32) * 1e-9)


def _clustered(rows: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A posting list dealt into blocks of similar documents: the rows in
    the order of their blocks, and where blocks start."""
    if len(rows) <= _BLOCK:
        return rows, np.zeros(1, dtype=np.int64)
    own = sketches[rows]
    centres = own[:: _BLOCK]
    label = (own @ centres.T).argmax(axis=1)
    order = np.argsort(label, kind="stable")
    label = label[order]
    return rows[order], np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))


class Search:
    """The best ``k`` documents of a block of items among the shards that
    were added; counts the blocks that were bounded and that were left out."""

    def __init__(self, block: _Block, k: int):
        self.block, self.k = block, k
        n = len(block.places)
        self.ids = [np.zeros(0, dtype=np.int64)] * n
        self.scores = [np.zeros(0, dtype=np.int64)] * n
        self.least = np.ones(n, dtype=np.int64)       # a smaller score is not among the best
        self.bounded = self.skipped = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """Index a shard and search it: document i has the next ``sizes[i]``
        of ``terms``, with their impacts."""
        b = self.block
        column = b.columns[terms]
        used = column >= 0
        x = np.zeros((len(ids), b.values.shape[1]), dtype=np.float32)     # impacts are below 2**24: exact
        x[np.repeat(np.arange(len(ids)), sizes)[used], column[used]] = impacts[used]
        sketches = x @ b.projection
        sketches /= np.linalg.norm(sketches, axis=1, keepdims=True) + 1e-30
        done = np.zeros((len(b.places), len(ids)), dtype=bool)
        for c, items, columns in b.lists:
            rows = np.flatnonzero(x[:, c])
            if not len(rows):
                continue
            rows, starts = _clustered(rows, sketches)
            summary = np.maximum.reduceat(x[np.ix_(rows, columns)], starts, axis=0)
            bounds = summary.astype(np.float64) @ b.values[np.ix_(items, columns)].astype(np.float64).T
            live = bounds * (1 + 1e-9) >= self.least[items]
            self.bounded += live.size
            self.skipped += live.size - np.count_nonzero(live)
            sizes_of = np.diff(np.append(starts, len(rows)))
            for i in np.flatnonzero(live.any(axis=0)):
                item = items[i]
                found = rows[np.repeat(live[:, i], sizes_of)]
                found = found[~done[item, found]]
                done[item, found] = True
                self._keep(item, ids[found], x, found)

    def _keep(self, item: int, ids: np.ndarray, x: np.ndarray, rows: np.ndarray) -> None:
        at = self.block.own[item]
        scores = x[np.ix_(rows, at)].astype(np.int64) @ self.block.values[item, at]
        good = scores >= self.least[item]
        if not good.any():
            return
        ids = np.concatenate([self.ids[item], ids[good]])
        scores = np.concatenate([self.scores[item], scores[good]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids[item], self.scores[item] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[item] = scores[order[-1]]


def _shards(batches: Iterable[pa.RecordBatch], most: int):
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def _impacts(n: np.ndarray, sizes: np.ndarray, tf: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = np.array([75 + 25 * x * documents // length for x in n.tolist()], dtype=np.int64)
    return 1_000_000_000 * tf // (1_000 * tf + 12 * np.repeat(m, sizes))


def _searched(shared, documents: int, length: int, k: int):
    """A task's best documents of each item, as (item, doc_id, score)."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        items, weights = shared.value
        searches = [Search(_block(items, places, terms, weights), k) for places, terms in items.blocks()]
        widest = max(s.block.values.shape[1] for s in searches)
        for shard in _shards(batches, max(1, min(_SHARD, _CELLS // widest))):
            terms, counts = shard.column("terms"), shard.column("counts")
            sizes = np.diff(terms.offsets.to_numpy())
            n, tf = shard.column("n").to_numpy(), counts.flatten().to_numpy()
            impacts = _impacts(n, sizes, tf, documents, length)
            for s in searches:
                s.add(shard.column("doc_id").to_numpy(), sizes, terms.flatten().to_numpy(), impacts)
        for s in searches:
            for place, ids, scores in zip(s.block.places, s.ids, s.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), place), pa.int32()), pa.array(ids), pa.array(scores)], schema=schema)
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id,
    text) its ``k`` documents of ``docs`` (doc_id, text) with the largest
    scores above 0 (all, if fewer), equal scores by ascending doc_id.

    With N documents that have a term, L their terms, n one document's, df
    the documents that hold a term and tf its occurrences in one, a term
    weighs w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))), and a document
    scores the sum, over the item's terms with repeats, of w * (10**9 * tf
    div (1000 * tf + 12 * m)), m being 75 + 25 * n * N div L.

    Null and empty texts have no term: such documents do not count, such
    items have no result.  Documents without a doc_id count in N, L and df
    and are not results; items without an item_id are left out.  Documents
    that repeat a row are documents each; items that repeat a row are one,
    and different texts under one item_id are items of their own, with ranks
    of their own.  Empty tables give an empty result.  Items go in groups
    of 8 MB of text; each group scans the documents once."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    items = items.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    results = []
    for group in _groups(items):
        with intermediates(spark):
            results.append(_ranked(docs, group, k, kind))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _ranked(docs: DataFrame, items: Items, k: int, kind: str) -> DataFrame:
    spark = docs.sparkSession
    terms = spark.sparkContext.broadcast(items.terms)        # of at most GROUP_BYTES of items, or of one item
    vectors = stored(docs.mapInArrow(_counted(terms), _VECTORS_SQL), "vectors")
    documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(items.terms), dtype=np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    shared = spark.sparkContext.broadcast((items, weights))
    names = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kind}")
    # the stored rows are small: read as they lie, few tasks would index many
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = (vectors.filter("doc_id is not null and size(terms) > 0").repartition(tasks)
            .mapInArrow(_searched(shared, documents, length or 1, k), "item int, doc_id long, score long")
            .withColumn("part", F.spark_partition_id() % _MERGES))
    order = (F.desc("score"), "doc_id")
    for keys in (["item", "part"], ["item"]):
        best = (best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                .filter(F.col("rank") <= k))
    out = stored(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked", keep=True)
    for used in (terms, shared):
        used.destroy()
    return out
