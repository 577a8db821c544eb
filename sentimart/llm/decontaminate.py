"""Benchmark decontamination by a prefix-filtered join of shingles.

An item's windows are sets of shingles of which a document must hold all
(containment 1), so the prefix that has to be joined is one shingle: the
window's rarest one over all documents.  Where it occurs, the window's
place is fixed: it must lie inside the document (length and positional
bounds), and its words are compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, intermediates, stored, text_bytes
from .windows import ranges

#: bytes of item windows that are broadcast at once; more go in further blocks
BLOCK_BYTES = 16 << 20
_FLAT = 1 << 20
_SHINGLE = 3
#: A-Z to a-z; every other ASCII byte but 0-9 and a-z separates words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _item_windows(window: int):
    def run(batches):
        for batch in batches:
            ids, texts = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), text_bytes(batch.column("text"))):
                words = words_of(text)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    ids.append(item)
                    texts.append(b" ".join(words[at:at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())],
                                             names=["item_id", "words"])
    return run


def _keys(ids: np.ndarray, size: int, base: int) -> np.ndarray:
    """One integer for each ``size`` consecutive word ids."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), dtype=np.int64)
    for i in range(size if n > 0 else 0):
        out = out * base + ids[i:i + n]
    return out


@dataclass
class _Index:
    """A block's windows, each once: word ids (0 beyond its size), items
    (``item_of[item_at[w]:item_at[w + 1]]``), and its shingles' numbers."""
    vocabulary: dict[bytes, int]
    words: np.ndarray
    sizes: np.ndarray
    item_at: np.ndarray
    item_of: list[str]
    shingles: dict[int, np.ndarray]     # by size: sorted keys
    numbers: np.ndarray                 # of a window's shingles, -1 beyond

    @property
    def offsets(self) -> dict[int, int]:
        """First shingle number of each size."""
        out, at = {}, 0
        for size in sorted(self.shingles):
            out[size] = at
            at += len(self.shingles[size])
        return out


def _index(rows: list[tuple[str, bytes]], window: int) -> _Index:
    by_words: dict[bytes, list[str]] = {}
    for item, words in rows:
        by_words.setdefault(bytes(words), []).append(item)
    vocabulary: dict[bytes, int] = {}
    split = [w.split() for w in by_words]
    words = np.zeros((len(split), window), dtype=np.int64)
    for i, ws in enumerate(split):
        words[i, :len(ws)] = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    base = len(vocabulary) + 1
    grams = np.minimum(sizes, _SHINGLE)
    numbers = np.full((len(split), max(1, window)), -1, dtype=np.int64)
    shingles, first = {}, 0
    for size in sorted(set(grams.tolist())):
        of = np.flatnonzero(grams == size)
        per = [_keys(words[i, :sizes[i]], size, base) for i in of]
        shingles[size] = np.unique(np.concatenate(per))
        for i, own in zip(of, per):
            numbers[i, :len(own)] = first + np.searchsorted(shingles[size], own)
        first += len(shingles[size])
    return _Index(vocabulary, words, sizes, np.concatenate(([0], np.cumsum([len(v) for v in by_words.values()]))),
                  [i for v in by_words.values() for i in v], shingles, numbers)


def _found_shingles(index: _Index, ids: np.ndarray, bounds: np.ndarray):
    """(position, shingle number) of the block's shingles in flat word ids,
    inside one document each."""
    for size, keys in index.shingles.items():
        if len(ids) < size:
            continue
        known = ids > 0
        inside = known[:len(ids) - size + 1].copy()
        for i in range(1, size):
            inside &= known[i:len(ids) - size + 1 + i]
        at = np.flatnonzero(inside)
        at = at[at + size <= bounds[np.searchsorted(bounds, at, side="right")]]
        if not len(at):
            continue
        base = len(index.vocabulary) + 1
        own = np.zeros(len(at), dtype=np.int64)
        for i in range(size):
            own = own * base + ids[at + i]
        place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        hit = keys[place] == own
        yield at[hit], index.offsets[size] + place[hit]


def _flat(index: _Index, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    get = index.vocabulary.get
    ids, ends = [], [0]
    for text in texts:
        ids.extend([get(w, 0) for w in words_of(text)])
        ends.append(len(ids))
    return np.array(ids, dtype=np.int64), np.array(ends, dtype=np.int64)


def _frequencies(shared):
    """Number of documents that hold each shingle of the block."""
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def run(batches):
        index = shared.value
        total = np.zeros(sum(map(len, index.shingles.values())), dtype=np.int64)
        for batch in batches:
            for piece in in_pieces(text_bytes(batch.column("text")), len, _FLAT):
                ids, bounds = _flat(index, piece)
                for at, number in _found_shingles(index, ids, bounds):
                    doc = np.searchsorted(bounds, at, side="right")
                    both = np.unique(doc * len(total) + number)
                    total += np.bincount(both % len(total), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], schema=schema)
    return run


@dataclass
class _Prefixes:
    """The windows filed under their rarest shingle:
    ``window_of[at[s]:at[s + 1]]`` and the shingle's offset in them."""
    at: np.ndarray
    window_of: np.ndarray
    offset: np.ndarray


def _prefixes(index: _Index, frequency: np.ndarray) -> _Prefixes:
    counts = np.where(index.numbers >= 0, frequency[index.numbers], np.iinfo(np.int64).max)
    offset = np.argmin(counts, axis=1)
    rows = np.arange(len(offset))
    prefix = index.numbers[rows, offset]
    order = np.argsort(prefix, kind="stable")
    order = order[counts[order, offset[order]] > 0]      # a shingle no document holds
    at = np.searchsorted(prefix[order], np.arange(len(frequency) + 1))
    return _Prefixes(at, order, offset[order])


def _occurrences(index: _Index, prefixes: _Prefixes, ids, bounds):
    """(start, window) of the windows found in flat word ids."""
    for position, shingle in _found_shingles(index, ids, bounds):
        counts = prefixes.at[shingle + 1] - prefixes.at[shingle]
        some = counts > 0
        position, shingle, counts = position[some], shingle[some], counts[some]
        cut = np.append(np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), _FLAT // 4)), len(counts))
        for a, b in zip(cut[:-1], cut[1:]):
            filed = ranges(prefixes.at[shingle[a:b]], counts[a:b])
            window = prefixes.window_of[filed]
            where = np.repeat(position[a:b], counts[a:b])
            start = where - prefixes.offset[filed]
            size = index.sizes[window]
            doc = np.searchsorted(bounds, where, side="right")
            fits = (start >= bounds[doc - 1]) & (start + size <= bounds[doc])
            start, window, size = start[fits], window[fits], size[fits]
            same = np.ones(len(start), dtype=bool)
            for i in range(index.words.shape[1]):
                inside = size > i
                same[inside] &= ids[start[inside] + i] == index.words[window[inside], i]
            yield start[same], window[same]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])
_FOUND_SQL = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def _search(shared, shared_prefixes):
    """Adds a block's occurrences to the spans (word ranges, merged) and
    items that a text already has."""
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        index, prefixes = shared.value, shared_prefixes.value
        n_words, spans, all_items = [], [], []
        rows = zip(text_bytes(texts), before.field("spans").to_pylist(), before.field("items").to_pylist())
        for piece in in_pieces(rows, lambda r: len(r[0]), _FLAT):
            ids, bounds = _flat(index, [r[0] for r in piece])
            hit = np.zeros(len(ids) + 1, dtype=np.int64)
            items: list[set] = [set(r[2]) for r in piece]
            for at, r in zip(bounds, piece):
                for span in r[1]:
                    hit[at + span["start"]] += 1
                    hit[at + span["end"]] -= 1
            for start, window in _occurrences(index, prefixes, ids, bounds):
                np.add.at(hit, start, 1)
                np.add.at(hit, start + index.sizes[window], -1)
                doc = np.searchsorted(bounds, start, side="right") - 1
                for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
                    items[d].update(index.item_of[index.item_at[w]:index.item_at[w + 1]])
            covered = np.cumsum(hit[:-1]) > 0
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = covered[a:b]
                edges = (np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).tolist()
                         if own.any() else [])
                spans.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2])])
            n_words.append(np.diff(bounds))
            all_items.extend(sorted(s) for s in items)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array(spans, _SPANS),
             pa.array(all_items, pa.list_(pa.string()))], fields=list(_FOUND))
    return F.arrow_udf(run, _FOUND_SQL)


def benchmark_overlap(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """(document, n_words, n_hit, spans, items) of every row of ``docs``
    (with doc_id and text; ``document`` holds all its columns) against
    ``items`` (item_id, text).  ``spans`` are the word ranges [start, end)
    inside an occurrence of ``window`` consecutive item words (of a whole
    shorter item), ``n_hit`` counts their words, ``items`` lists the ids, as
    sorted strings, of the items with occurring windows.

    Words are lower-cased (A-Z) runs of digits, letters and non-ASCII.
    Null texts have no words; items without words or with a null item_id
    take no part; rows that repeat an item_id add to one item; repeated
    document rows get one row each; empty tables match nothing.

    The items' windows are broadcast in blocks of at most ``BLOCK_BYTES``;
    every block costs one counting scan of the documents and one step of
    the final scan, in which no row is shuffled."""
    spark = docs.sparkSession
    with intermediates(spark):
        windows = stored(
            items.filter("item_id is not null").select(F.col("item_id").cast("string"), "text")
            .mapInArrow(_item_windows(window), "item_id string, words binary").distinct(), "windows")
        total = windows.agg(F.sum(F.octet_length("words") + F.octet_length("item_id"))).first()[0] or 0
        blocks = int(total // BLOCK_BYTES) + 1
        found = F.struct(F.lit(0).cast("long").alias("n_words"),
                         F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
                         F.array().cast("array<string>").alias("items"))
        for block in range(blocks):
            mine = F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block
            index = _index([tuple(r) for r in windows.filter(mine).toLocalIterator()], window)
            shared = spark.sparkContext.broadcast(index)
            frequency = np.zeros(sum(map(len, index.shingles.values())), dtype=np.int64)
            if len(frequency):
                counted = (docs.select("text").filter("text is not null")
                           .mapInArrow(_frequencies(shared), "shingle long, n long").groupBy("shingle").agg(F.sum("n")))
                for number, n in counted.toLocalIterator():
                    frequency[number] = n
            prefixes = spark.sparkContext.broadcast(_prefixes(index, frequency))
            found = _search(shared, prefixes)("document.text", found)
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (docs.select(F.struct("*").alias("document")).select("document", found.alias("found"))
            .select("document", "found.n_words", n_hit.alias("n_hit"), "found.spans", "found.items"))
