"""Repeated fixed-length windows over a whole corpus, exactly.

Shared by ``substring_dedup`` (windows of words) and ``suffix_dedup``
(windows of bytes).  Three scans of the texts, none of which moves a text:

1. each task counts its segments' anchors in a count-min sketch; the
   partition sketches are merged block by block, and only the bit maps
   "counted more than once" / "with more than one segment content" remain,
   whose size is fixed by ``cells`` and not by the input;
2. segments whose anchor is estimated repeated are grouped exactly by
   (anchor, content): the earliest occurrence of each content stays, and
   contents that share an anchor with another content go to a ``judge``
   that compares their windows;
3. the segments estimated repeated meet those verdicts.

The sketch only over-estimates, so no repeat is lost; a fuller sketch
passes more to the exact steps.  ``cells`` should be a few times the
corpus's symbols divided by half the window length (2**27 cells: 16 MB a
map, and few false alarms up to some 10**8 segments).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, intermediates, stored, text_bytes
from .sketch import Sketch, estimates, sketch
from .windows import BYTE_SYMBOLS, Segments, ranges, segments

_FLAT = 1 << 18          # bytes of text handled at once
_REMEMBER = 400_000      # contents a task remembers to send each only once


@dataclass(frozen=True)
class Windows:
    """``length`` symbols a window, filed under a gram of ``k`` symbols."""
    length: int
    k: int
    words: bool          # symbols are white-space separated words, else bytes
    cells: int = 1 << 27
    depth: int = 1

    def __post_init__(self):
        if not 0 < self.k <= self.length:
            raise ValueError("k must be 1..length")

    @property
    def sketch(self) -> Sketch:
        return Sketch(self.cells, self.depth)


def _flat(windows: Windows, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Symbols of all texts in one array, the texts' bounds in it, and the
    joined bytes."""
    if windows.words:
        words = [t.split() for t in texts]
        sizes = [len(w) for w in words]
        symbols = np.fromiter((xxhash.xxh64_intdigest(w) for ws in words for w in ws),
                              dtype=np.uint64, count=sum(sizes))
        joined = b""
    else:
        joined = b"".join(texts)
        sizes = [len(t) for t in texts]
        symbols = BYTE_SYMBOLS[np.frombuffer(joined, dtype=np.uint8)]
    return symbols, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), joined


def _pieces(windows: Windows, batches) -> Iterator[tuple[list, list, Segments, np.ndarray, bytes]]:
    """Segments of a few texts at a time: ids, text keys, segments, bounds,
    joined bytes."""
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(),
                   text_bytes(batch.column("text")))
        for piece in in_pieces(rows, lambda r: len(r[2]), _FLAT):
            symbols, bounds, joined = _flat(windows, [r[2] for r in piece])
            found = segments(symbols, bounds, windows.length, windows.k)
            if len(found.start):
                yield ([r[0] for r in piece], [r[1] for r in piece], found, bounds, joined)


def _entries(windows: Windows):
    def run(batches):
        for _, _, found, _, _ in _pieces(windows, batches):
            yield found.anchor, found.digest
    return run


_MEMBER = [("anchor", pa.int64()), ("digest", pa.int64()), ("doc_id", pa.int64()),
           ("text_key", pa.int64()), ("start", pa.int64()), ("n_windows", pa.int32())]
_MEMBER_SQL = "anchor long, digest long, doc_id long, text_key long, start long, n_windows int"


def _member_columns(ids, keys, found: Segments, bounds, keep: np.ndarray) -> list[pa.Array]:
    doc = found.doc[keep]
    return [pa.array(found.anchor[keep].view(np.int64)), pa.array(found.digest[keep].view(np.int64)),
            pa.array(np.array(ids, dtype=np.int64)[doc]), pa.array(np.array(keys, dtype=np.int64)[doc]),
            pa.array(found.start[keep] - bounds[doc]),
            pa.array(found.n_windows[keep].astype(np.int32))]


def _members(windows: Windows, maps):
    schema = pa.schema(_MEMBER)

    def run(batches):
        for ids, keys, found, bounds, _ in _pieces(windows, batches):
            keep = np.flatnonzero(estimates(windows.sketch, maps.value, found.anchor, ("repeated",))[0])
            if len(keep):
                yield pa.RecordBatch.from_arrays(_member_columns(ids, keys, found, bounds, keep), schema=schema)
    return run


def _payload(windows: Windows, found: Segments, joined: bytes, at: np.ndarray) -> list:
    """What the judge gets of segments: hashes of the windows (words) or the
    bytes themselves."""
    counts = found.n_windows[at]
    if not windows.words:
        return [joined[s:s + n - 1 + windows.length] for s, n in zip(found.start[at].tolist(), counts.tolist())]
    starts = ranges(found.start[at], counts)
    hashes = found.hashes.slices(starts, starts + windows.length).view(np.int64)
    return np.split(hashes, np.cumsum(counts)[:-1])


def _contents(windows: Windows, maps):
    """Segments estimated repeated, each content's earliest one in the
    task, with the judge's payload if its anchor is estimated mixed."""
    payload_type = pa.list_(pa.int64()) if windows.words else pa.binary()
    schema = pa.schema([*_MEMBER, ("payload", payload_type)])

    def run(batches):
        seen: dict[tuple[int, int], tuple] = {}
        for ids, keys, found, bounds, joined in _pieces(windows, batches):
            repeated, mixed = estimates(windows.sketch, maps.value, found.anchor)
            at = np.flatnonzero(repeated)
            place = found.start[at] - bounds[found.doc[at]]
            keep = []
            for i, a, d, doc, start in zip(at.tolist(), found.anchor[at].tolist(), found.digest[at].tolist(),
                                           found.doc[at].tolist(), place.tolist()):
                order = (ids[doc], keys[doc], start)
                if seen.get((a, d), order) >= order:
                    if len(seen) >= _REMEMBER:
                        seen.clear()
                    seen[a, d] = order
                    keep.append(i)
            if not keep:
                continue
            keep = np.array(keep)
            payload = [None] * len(keep)
            sent = np.flatnonzero(mixed[keep])
            if len(sent):
                for i, p in zip(sent.tolist(), _payload(windows, found, joined, keep[sent])):
                    payload[i] = p
            yield pa.RecordBatch.from_arrays(
                [*_member_columns(ids, keys, found, bounds, keep), pa.array(payload, payload_type)], schema=schema)
    return run


def shared_windows(rows: DataFrame, order) -> DataFrame:
    """Exact grouping of windows: of ``rows`` (anchor, digest, first,
    ``hashes`` of the windows) the indexes of those windows that also occur
    with a smaller ``order`` (a column over ``first`` and ``j``); one row
    (anchor, digest, mask array<int>) a content that has any.  Windows are
    told apart by anchor hash and window hash, 128 bits."""
    each = rows.select("anchor", "digest", "first", F.posexplode("hashes").alias("j", "window"))
    each = each.select("anchor", "digest", "window", "j", order.alias("order"))
    least = (each.groupBy("anchor", "window").agg(F.min("order").alias("least"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    return (each.join(least, ["anchor", "window"]).filter("order > least")
            .groupBy("anchor", "digest").agg(F.collect_list("j").alias("mask")))


def repeated_parts(docs: DataFrame, windows: Windows, judge: Callable[[DataFrame], DataFrame],
                   earlier) -> DataFrame:
    """(doc_id, text_key, parts): each document's segments with windows to
    remove; ``parts`` holds (start, n_windows, mask), a null mask meaning
    every window.  ``judge`` gets the contents with a payload and returns
    their masks; ``earlier`` says, over ``first`` and a member's columns,
    whether the content's first occurrence makes all the member's windows
    removable."""
    spark = docs.sparkSession
    docs = (docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text"))
    with intermediates(spark):
        maps = spark.sparkContext.broadcast(sketch(docs, windows.sketch, _entries(windows)))
        payload = "array<long>" if windows.words else "binary"
        contents = stored(
            docs.mapInArrow(_contents(windows, maps), f"{_MEMBER_SQL}, payload {payload}")
            .groupBy("anchor", "digest")
            .agg(F.min(F.struct("doc_id", "text_key", "start")).alias("first"),
                 F.first("payload", ignorenulls=True).alias("payload")), "contents")
        masks = stored(judge(contents.filter("payload is not null")), "masks")
        # stored, so that the join with the members has one exchange a side and
        # AQE can split a content with very many of them
        verdicts = stored(contents.drop("payload").join(masks, ["anchor", "digest"], "left"), "verdicts")
        members = docs.mapInArrow(_members(windows, maps), _MEMBER_SQL)
        met = members.join(verdicts, ["anchor", "digest"])
        whole = earlier()
        parts = stored(
            met.filter(whole | F.col("mask").isNotNull())
            .select("doc_id", "text_key", F.struct(
                "start", "n_windows", F.when(~whole, F.col("mask")).alias("mask")).alias("part"))
            .groupBy("doc_id", "text_key").agg(F.collect_list("part").alias("parts")), "parts", keep=True)
        maps.destroy()
    return parts


def with_parts(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Each document (doc_id, text) with its parts (null: none).  The parts
    are the hashed side, so the texts are moved once and never sorted."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return docs.join(parts.hint("shuffle_hash"), ["doc_id", "text_key"], "left").drop("text_key")


def removable(column: pa.ListArray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """For each row of a ``parts`` column the symbol ranges (starts, ends)
    that its parts remove, None where it has none."""
    values, offsets = column.values, column.offsets.to_numpy()
    start, n = values.field("start").to_numpy(), values.field("n_windows").to_numpy()
    mask = values.field("mask")
    masked, at = mask.is_valid().to_numpy(zero_copy_only=False), mask.offsets.to_numpy().astype(np.int64)
    index = mask.values.to_numpy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if a == b:
            yield None
            continue
        whole, some = a + np.flatnonzero(~masked[a:b]), a + np.flatnonzero(masked[a:b])
        counts = at[some + 1] - at[some]
        single = np.repeat(start[some], counts) + index[ranges(at[some], counts)]
        yield (np.concatenate((start[whole], single)),
               np.concatenate((start[whole] + n[whole] - 1, single)) + length)


def covered(size: int, spans: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of a text's symbols lie in one of the ranges."""
    starts, ends = spans
    edges = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(edges[:-1]) > 0
