"""A count-min sketch of a corpus, built in tasks and merged block by block.

Each cell also tells whether all its entries had one *content* (a 64-bit
hash), so the merged sketch answers two questions about a key, both never
too low: was it counted more than once, and with more than one content.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .windows import mix

_BLOCK_BITS = 16         # map bits a block
_TAG_BITS = 8            # sketch cells a map bit, as a power of two
_FLUSH = 1 << 18         # keys a task gathers before it emits a sketch
_FAN_IN = 64             # partition sketches merged at once


@dataclass(frozen=True)
class Sketch:
    """``depth`` rows, each of ``cells`` map bits with 256 sketch cells a bit.

    The cells are counted where they are stored, spread over the cluster;
    only the maps, a bit for 256 cells, go to every task.  So two keys are
    confused when they share a cell (few, up to some 10**9 keys), and a key
    is passed on needlessly when its bit was set by a key that is repeated
    (about the number of repeated keys over ``cells``)."""
    cells: int
    depth: int = 1

    def __post_init__(self):
        if self.cells & (self.cells - 1) or self.cells < 1 << _BLOCK_BITS:
            raise ValueError("cells must be a power of two of at least 2**16")


def _cells(shape: Sketch, keys: np.ndarray, row: int) -> np.ndarray:
    """The keys' cells in one row of the sketch, numbered through."""
    salt = np.uint64(0x632BE59BD9B4E019 * (row + 1) % (1 << 64))
    bits = shape.cells.bit_length() - 1 + _TAG_BITS
    return (mix(keys + salt) >> np.uint64(64 - bits)).astype(np.int64) + (row * shape.cells << _TAG_BITS)


#: states of a cell: seen once, several times with one content, with several contents
_ONCE, _COPIES, _MIXED = 1, 2, 3
_SKETCH = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("cells", pa.binary()),
                     ("states", pa.binary()), ("contents", pa.binary())])
_SKETCH_SQL = "block int, part int, cells binary, states binary, contents binary"


def _reduce(cells, states, contents) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry a cell: its state and one of its contents."""
    order = np.argsort(cells, kind="stable")
    cells, states, contents = cells[order], states[order], contents[order]
    first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    low, high = np.minimum.reduceat(contents, first), np.maximum.reduceat(contents, first)
    most = np.maximum.reduceat(states, first)
    alone = np.diff(np.append(first, len(cells))) == 1
    state = np.where(low != high, _MIXED, np.where(alone, most, np.maximum(most, _COPIES)))
    return cells[first], state.astype(np.uint8), low


def _sketch_rows(cells, states, contents, part: int) -> Iterator[pa.RecordBatch]:
    blocks = cells >> (_BLOCK_BITS + _TAG_BITS)
    cut = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True])))
    inner = (cells & ((1 << _BLOCK_BITS + _TAG_BITS) - 1)).astype(np.uint32)
    for at in range(0, len(cut) - 1, 512):
        edges = cut[at:at + 513]
        spans = list(zip(edges[:-1], edges[1:]))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(blocks[a]) for a, _ in spans], pa.int32()),
            pa.array([part] * len(spans), pa.int32()),
            pa.array([inner[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([states[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([contents[a:b].tobytes() for a, b in spans], pa.binary())], schema=_SKETCH)


def _count(shape: Sketch, entries):
    def run(batches):
        part = TaskContext.get().partitionId()
        keys, contents, held = [], [], 0

        def flush():
            k, c = np.concatenate(keys), np.concatenate(contents)
            cells = np.concatenate([_cells(shape, k, row) for row in range(shape.depth)])
            ones = np.full(len(cells), _ONCE, dtype=np.uint8)
            yield from _sketch_rows(*_reduce(cells, ones, np.tile(c, shape.depth)), part)

        for some_keys, some_contents in entries(batches):
            keys.append(some_keys)
            contents.append(some_contents)
            held += len(some_keys)
            if held >= _FLUSH:
                yield from flush()
                keys, contents, held = [], [], 0
        if held:
            yield from flush()
    return run


def _merged(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """One block's sketches as one: number of the block, cells, states, contents."""
    parts = [np.frombuffer(b"".join(table.column(n).to_pylist()), dtype=t)
             for n, t in (("cells", np.uint32), ("states", np.uint8), ("contents", np.uint64))]
    return (table.column("block")[0].as_py(), *_reduce(*parts))


def _merge(fan_in: int):
    def run(table: pa.Table) -> pa.Table:
        block, cells, states, contents = _merged(table)
        part = table.column("part")[0].as_py() // fan_in
        return pa.Table.from_pylist([{"block": block, "part": part, "cells": cells.tobytes(),
                                      "states": states.tobytes(), "contents": contents.tobytes()}],
                                    schema=_SKETCH)
    return run


_MAPS = pa.schema([("block", pa.int32()), ("repeated", pa.binary()), ("mixed", pa.binary())])


def _maps(table: pa.Table) -> pa.Table:
    block, cells, states, _ = _merged(table)
    out = {"block": block}
    for name, least in (("repeated", _COPIES), ("mixed", _MIXED)):
        bits = np.zeros(1 << _BLOCK_BITS, dtype=np.uint8)
        bits[cells[states >= least] >> _TAG_BITS] = 1
        out[name] = zlib.compress(np.packbits(bits).tobytes(), 1)
    return pa.Table.from_pylist([out], schema=_MAPS)


class Maps:
    """A merged sketch's bit maps, compressed block by block: so they pass
    through the driver and the broadcast; a task unpacks the one it asks
    for once."""

    def __init__(self, size: int, blocks: dict[str, dict[int, bytes]]):
        self._size, self._blocks, self._dense = size, blocks, {}

    def __getstate__(self):
        return {**self.__dict__, "_dense": {}}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._dense:
            step = (1 << _BLOCK_BITS) // 8
            dense = np.zeros(self._size, dtype=np.uint8)
            for block, packed in self._blocks[name].items():
                dense[block * step:(block + 1) * step] = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
            self._dense[name] = dense
        return self._dense[name]


def sketch(docs: DataFrame, shape: Sketch, entries: Callable) -> Maps:
    """Bit maps of the merged count-min sketch, ``depth * cells`` bits each:
    ``repeated`` (counted more than once) and ``mixed`` (with more than one
    content).  ``entries`` turns a task's Arrow batches of ``docs`` into
    pairs of uint64 arrays (keys, contents).  The maps' size depends on the
    sketch alone, so they may be broadcast."""
    parts = (docs.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0] or 0) + 1
    rows = docs.mapInArrow(_count(shape, entries), _SKETCH_SQL)
    while parts > _FAN_IN:
        group = F.floor(F.col("part") / _FAN_IN).alias("group")
        rows = rows.groupBy("block", group).applyInArrow(_merge(_FAN_IN), _SKETCH_SQL)
        parts = -(-parts // _FAN_IN)
    found = stored(rows.groupBy("block").applyInArrow(
        _maps, "block int, repeated binary, mixed binary"), "sketch")
    blocks: dict[str, dict[int, bytes]] = {"repeated": {}, "mixed": {}}
    for row in found.toLocalIterator():      # one row a block: bounded by the sketch's size
        for name in blocks:
            blocks[name][row["block"]] = bytes(row[name])
    return Maps(shape.cells * shape.depth // 8, blocks)


def estimates(shape: Sketch, maps: Maps, keys: np.ndarray, names=("repeated", "mixed")) -> list[np.ndarray]:
    """Whether each key is estimated repeated / mixed: the least of its rows."""
    answers = []
    for name in names:
        yes = np.ones(len(keys), dtype=bool)
        for row in range(shape.depth):
            cells = _cells(shape, keys, row) >> _TAG_BITS
            yes &= (maps[name][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
        answers.append(yes)
    return answers
