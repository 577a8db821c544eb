"""Rolling hashes and anchors of fixed-length windows, in numpy.

A window is ``length`` consecutive symbols of one document (words in
``substring_dedup``, bytes in ``suffix_dedup``).  Each window is filed
under its *anchor*: the k-gram inside it whose hash is smallest (leftmost
on a tie).  The choice depends on the window's content alone, so equal
windows have equal anchors at equal offsets, wherever they occur.
Consecutive windows with one anchor position form a *segment*; every
window lies in exactly one segment, and two windows can only be equal when
their segments have the same anchor hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse mod 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POSITION_BITS = 24                     # positions inside one flat array
MAX_SYMBOLS = 1 << _POSITION_BITS
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class SliceHashes:
    """Hashes of arbitrary slices of one symbol array: a polynomial sum
    modulo 2**64 kept as prefix sums, shifted back to position 0."""

    def __init__(self, symbols: np.ndarray):
        up, self._down = _powers(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=self._sums[1:])

    def every(self, k: int) -> np.ndarray:
        """Mixed hash of each k-gram, by start."""
        raw = self._sums[k:] - self._sums[:-k]
        return mix(raw * self._down[: len(raw)])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_BASE))

    def without_one(self) -> np.ndarray:
        """Hash of the whole array, then of the array without each symbol."""
        n = len(self._sums) - 1
        total = self._sums[n]
        shorter = self._sums[:-1] + (total - self._sums[1:]) * self._down[1]
        raw = np.concatenate((self._sums[n:], shorter))
        size = np.full(n + 1, n - 1, dtype=np.uint64)
        size[0] = n
        return mix(raw + size * np.uint64(_BASE))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive entries (doubling)."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` consecutive gram hashes,
    leftmost on a tie: hash and position are packed into one integer, in
    stretches short enough for the position bits."""
    low = np.uint64(MAX_SYMBOLS - 1)
    step = MAX_SYMBOLS - width
    found = []
    for begin in range(0, len(grams) - width + 1, step):
        part = grams[begin:begin + step + width - 1]
        packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        found.append((sliding_min(packed, width) & low).astype(np.int64) + begin)
    return np.concatenate(found)


@dataclass
class Segments:
    """Parallel arrays; positions are relative to the flat symbol array."""
    doc: np.ndarray      # index of the document
    start: np.ndarray    # first window start, flat
    n_windows: np.ndarray
    anchor: np.ndarray   # uint64 hash of the anchor k-gram
    digest: np.ndarray   # uint64 hash of the whole segment (start .. last window's end)
    hashes: SliceHashes | None


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)``."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    out = np.ones(total, dtype=np.int64)
    keep = counts > 0
    starts, counts = starts[keep], counts[keep]
    ends = np.cumsum(counts)
    out[0] = starts[0]
    out[ends[:-1]] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)


def segments(symbols: np.ndarray, bounds: np.ndarray, length: int, k: int) -> Segments:
    """Segments of all windows of ``length`` symbols.  ``bounds`` holds the
    documents' ends in the flat array, starting with 0."""
    sizes = np.diff(bounds)
    n_windows = np.maximum(sizes - length + 1, 0)
    if not n_windows.any():
        none = np.zeros(0, dtype=np.int64)
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64), None)
    hashes = SliceHashes(symbols)
    grams = hashes.every(k)
    starts = ranges(bounds[:-1], n_windows)
    at = _smallest(grams, length - k + 1)[starts]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    counts = np.diff(np.append(first, len(at)))
    begin = starts[first]
    return Segments(
        doc=np.searchsorted(bounds, begin, side="right") - 1, start=begin, n_windows=counts,
        anchor=grams[at[first]], digest=hashes.slices(begin, begin + counts - 1 + length),
        hashes=hashes)
