"""Substring deduplication with sharded suffix arrays (byte strings)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, stored, text_bytes
from .repeats import Windows, covered, removable, repeated_parts, shared_windows, with_parts
from .suffix_array import common_prefixes, suffix_array
from .windows import BYTE_SYMBOLS, SliceHashes

#: bytes a shard's suffix array is meant to hold
SHARD_BYTES = 1 << 20
_CLOSING, _SEPARATOR, _FIRST = 0, 1, 2       # symbols before the 256 byte values
_MASKS = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("mask", pa.list_(pa.int32()))])
_HASHES_SQL = ("anchor long, digest long, first struct<doc_id: long, text_key: long, start: long>, "
               "hashes array<long>")
_MASKS_SQL = "anchor long, digest long, mask array<int>"


def _earlier_windows(texts: list[bytes], firsts: list[tuple], length: int):
    """For each text the window starts whose bytes also start earlier:
    ``firsts`` orders the texts (document, ..., start of the text in it).
    Equal windows are neighbours in the suffix array."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.frombuffer(b"\xff".join(texts) + b"\xff\xff", dtype=np.uint8).astype(np.uint16) + _FIRST
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    flat[begins + sizes] = _SEPARATOR
    flat[-1] = _CLOSING
    order = suffix_array(flat, _FIRST + 256)
    shared = common_prefixes(flat, order)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    order = order[order < len(flat) - 1]
    offset = order - begins[owner[order]]
    # only whole windows; any suffix between two equal ones is one too
    whole = offset + length <= sizes[owner[order]]
    order, offset = order[whole], offset[whole]
    if not len(order):
        return [], []
    of = owner[order]
    new = shared[order] < length
    new[0] = True
    group = np.flatnonzero(new)
    documents = {d: i for i, d in enumerate(sorted({f[:-1] for f in firsts}))}
    document = np.array([documents[f[:-1]] for f in firsts], dtype=np.int64)[of]
    place = np.array([f[-1] for f in firsts], dtype=np.int64)[of] + offset
    # rank of (document, place), so that one integer orders the windows
    rank = np.empty(len(order), dtype=np.int64)
    rank[np.lexsort((place, document))] = np.arange(len(order))
    least = np.repeat(np.minimum.reduceat(rank, group), np.diff(np.append(group, len(order))))
    later = np.flatnonzero(rank > least)
    return of[later], offset[later]


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        firsts = [(f["doc_id"], f["text_key"], f["start"]) for f in table.column("first").to_pylist()]
        of, offset = _earlier_windows(table.column("payload").to_pylist(), firsts, length)
        if not len(of):
            return _MASKS.empty_table()
        order = np.lexsort((offset, of))
        of, offset = np.asarray(of)[order], np.asarray(offset)[order]
        cut = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        which = pa.array(of[cut])
        return pa.Table.from_arrays(
            [table.column("anchor").take(which), table.column("digest").take(which),
             pa.ListArray.from_arrays(pa.array(np.append(cut, len(of)), pa.int32()),
                                      pa.array(offset.astype(np.int32)))], schema=_MASKS)
    return run


def _with_hashes(length: int):
    """The contents with the hashes of their windows in place of the bytes."""
    def run(batches):
        for batch in batches:
            hashes = []
            for text in batch.column("payload").to_pylist():
                each = SliceHashes(BYTE_SYMBOLS[np.frombuffer(text, dtype=np.uint8)])
                starts = np.arange(len(text) - length + 1)
                hashes.append(each.slices(starts, starts + length).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("digest"), batch.column("first"),
                 pa.array(hashes, pa.list_(pa.int64()))], names=["anchor", "digest", "first", "hashes"])
    return run


def _judge(length: int):
    """Masks of contents that share an anchor.  Anchors are dealt to shards
    of about ``SHARD_BYTES``; each shard's suffix array brings its equal
    windows together.  An anchor with more bytes than a shard takes (a very
    common passage in ever new surroundings) is not gathered in one task:
    its windows are grouped by their hashes over the whole cluster."""
    def run(contents: DataFrame) -> DataFrame:
        size = F.octet_length("payload")
        anchors = stored(contents.groupBy("anchor").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
                         .filter("n > 1"), "anchors")
        total = anchors.agg(F.sum("bytes")).first()[0] or 0
        shards = int(total // SHARD_BYTES) + 1
        rows = contents.join(anchors.drop("n"), "anchor")
        # as many tasks as there are, as shards are small and cost CPU
        tasks = min(shards, int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        normal = (rows.filter(F.col("bytes") <= SHARD_BYTES)
                  .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(tasks, "shard")
                  .groupBy("shard").applyInArrow(_shard(length), _MASKS_SQL))
        hot = (rows.filter(F.col("bytes") > SHARD_BYTES).select("anchor", "digest", "first", "payload")
               .mapInArrow(_with_hashes(length), _HASHES_SQL))
        order = F.struct("first.doc_id", "first.text_key", (F.col("first.start") + F.col("j")).alias("start"))
        return normal.unionByName(shared_windows(hot, order))
    return run


def _kept(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("kept", pa.large_binary())])

    def run(batches):
        for batch in sliced(batches):
            out = []
            for doc, text, ranges in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")),
                                         removable(batch.column("parts"), length)):
                spans, kept = [], text
                if ranges:
                    hit = covered(len(text), ranges)
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
                    kept = np.frombuffer(text, dtype=np.uint8)[~hit].tobytes()
                out.append((doc, len(text), len(text) - len(kept), spans, kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)] if out
                else [pa.array([], t) for t in schema.types], schema=schema)
    return run


def dedup_byte_windows(docs: DataFrame, length: int = 100, k: int = 32, cells: int = 1 << 27) -> DataFrame:
    """Remove each byte of ``docs`` (doc_id, text; other columns are not
    read) covered by a ``length``-byte string that also starts earlier: in
    a document with a smaller doc_id or before in the same one.  Texts are
    UTF-8 bytes; matches never cross documents; overlaps count; strings are
    judged on the input.

    Returns (doc_id, n_bytes, n_removed, spans, kept): one row an input
    row, ``spans`` the removed byte ranges [start, end) and ``kept`` the
    remaining bytes (binary: a cut may fall inside a character).  Null
    texts are empty; rows with a null doc_id are returned whole and take no
    part; repeated rows (same doc_id and text) count as one document, and
    different texts under one doc_id are ordered by a hash of the text; an
    empty table gives an empty result.

    Segments whose anchor is not repeated are pruned without loss, equal
    segments collapse to their first one (``repeats``), and the rest is
    compared in suffix-array shards."""
    windows = Windows(length, k, words=False, cells=cells)
    first = ("doc_id", "text_key", "start")
    parts = repeated_parts(
        docs, windows, judge=_judge(length),
        earlier=lambda: F.struct(*(F.col(f"first.{c}") for c in first)) < F.struct(*first))
    return with_parts(docs, parts).mapInArrow(
        _kept(length), "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
