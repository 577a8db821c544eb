"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

A sweep of the induced sort over a small alphabet visits the buckets in
order and moves all predecessors of a bucket's entries at once, so it is a
few array operations a bucket and linear work in all.
"""

from __future__ import annotations

import numpy as np

#: entries a bucket on average from which a sweep goes bucket by bucket
_LARGE_BUCKET = 32


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour (S type).
    ``s`` ends with a unique smallest symbol."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    # a tie takes the type of the next position that differs
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    place = np.minimum.accumulate(place[::-1])[::-1]
    smaller = np.ones(n, dtype=bool)
    decided = place < n - 1
    smaller[:-1][decided] = step[place[decided]] > 0
    return smaller


def _place(sa, pointer, symbols, entries, forward: bool) -> None:
    """Write entries at their buckets' heads (or tails), keeping their order."""
    order = np.argsort(symbols, kind="stable")
    symbols, entries = symbols[order], entries[order]
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    counts = np.diff(np.append(first, len(symbols)))
    rank = np.arange(len(symbols)) - np.repeat(first, counts)
    if forward:
        sa[pointer[symbols] + rank] = entries
        pointer[symbols[first]] += counts
    else:
        sa[pointer[symbols] - 1 - rank] = entries
        pointer[symbols[first]] -= counts


def _induce(s, smaller, lms, bounds) -> np.ndarray:
    """Suffix array (exact up to the order given for ``lms``): larger types
    from left to right, then smaller types from right to left."""
    sa = np.full(len(s), -1, dtype=np.int64)
    head, n_symbols = bounds[:-1].copy(), len(bounds) - 1
    cuts = np.searchsorted(s[lms], np.arange(n_symbols + 1))
    for c in range(n_symbols):
        done = bounds[c]
        while done < head[c]:                    # entries may join this very bucket
            now = sa[done:head[c]]
            done = head[c]
            _larger(sa, s, smaller, head, now)
        if cuts[c] < cuts[c + 1]:
            _larger(sa, s, smaller, head, lms[cuts[c]:cuts[c + 1]])
    tail = bounds[1:].copy()
    sa[0] = len(s) - 1                           # the closing symbol's own bucket
    for c in range(n_symbols - 1, -1, -1):
        done = bounds[c + 1]
        while tail[c] < done:
            now = sa[tail[c]:done][::-1]
            done = tail[c]
            _smaller(sa, s, smaller, tail, now)
        if bounds[c] < head[c]:
            _smaller(sa, s, smaller, tail, sa[bounds[c]:head[c]][::-1])
    return sa


def _larger(sa, s, smaller, head, now) -> None:
    before = now[now > 0] - 1
    before = before[~smaller[before]]
    if len(before):
        _place(sa, head, s[before], before, forward=True)


def _smaller(sa, s, smaller, tail, now) -> None:
    before = now[now > 0] - 1
    before = before[smaller[before]]
    if len(before):
        _place(sa, tail, s[before], before, forward=False)


def _names(s, lms, ordered) -> tuple[np.ndarray, int]:
    """Rank of each leftmost-smaller substring (in text order): equal
    substrings get equal ranks.  ``ordered`` lists them sorted."""
    size = np.empty(len(lms), dtype=np.int64)
    size[:-1] = np.diff(lms) + 1                 # up to and including the next one's first symbol
    size[-1] = 1
    of = np.empty(len(s), dtype=np.int64)
    of[lms] = np.arange(len(lms))
    a, b = ordered[:-1], ordered[1:]
    length = size[of[a]]
    same = length == size[of[b]]
    at, left = 0, np.flatnonzero(same)
    while len(left):
        left = left[length[left] > at]
        differs = s[a[left] + at] != s[b[left] + at]
        same[left[differs]] = False
        left = left[~differs]
        at += 1
    rank = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(len(lms), dtype=np.int64)
    names[of[ordered]] = rank
    return names, int(rank[-1]) + 1


def _induce_singly(s, smaller, lms, bounds) -> np.ndarray:
    """The same two sweeps entry by entry, for alphabets of which most
    buckets are small."""
    n, first = len(s), s[lms]                    # ``lms`` is in the order of its first symbols
    own = np.bincount(first, minlength=len(bounds) - 1)
    sa = np.full(n, -1, dtype=np.int64)
    sa[bounds[1:][first] - own[first] + np.arange(len(lms)) - (np.cumsum(own) - own)[first]] = lms
    sa = sa.tolist()
    # the symbol before each position, where that is of the type that a
    # sweep moves, else -1; so is what stands for "no entry", the last one
    before = np.concatenate(([-1], s[:-1].astype(np.int64), [-1]))
    rises = np.concatenate(([False], smaller[:-1], [False]))
    symbol, head = np.where(rises, -1, before).tolist(), bounds[:-1].tolist()
    for at in sa:                                # sees what the loop itself writes further on
        c = symbol[at]
        if c >= 0:
            sa[head[c]] = at - 1
            head[c] += 1
    symbol, tail = np.where(rises, before, -1).tolist(), bounds[1:].tolist()
    for at in reversed(sa):
        c = symbol[at]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = at - 1
    return np.array(sa, dtype=np.int64)


def suffix_array(s: np.ndarray, n_symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order.  Symbols are 0 ..
    ``n_symbols`` - 1 and the last one is the only 0.

    The suffixes are classified, the leftmost-smaller substrings are
    sorted by one induced sweep and named, the string of their names is
    sorted recursively, and its order induces all suffixes.  The work is
    linear.  A sweep goes bucket by bucket where these are large, and entry
    by entry where they are not (the names of deeper levels)."""
    if len(s) == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    bounds = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=n_symbols))))
    induce = _induce if len(s) >= _LARGE_BUCKET * n_symbols else _induce_singly
    rough = induce(s, smaller, lms[np.argsort(s[lms], kind="stable")], bounds)
    is_lms = np.zeros(len(s), dtype=bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    names, n_names = _names(s, lms, ordered)
    if n_names < len(lms):
        ordered = lms[suffix_array(names, n_names)]
    return induce(s, smaller, ordered, bounds)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each position of ``s`` (uint16) the
    number of symbols its suffix shares with the one before it in ``sa``.
    Only positions whose left symbols differ from their neighbour's are
    compared, four symbols at a time; any other has one less than the
    position to its left."""
    n = len(s)
    before = np.empty(n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    place = np.arange(n)
    follows = (place > 0) & (before > 0)
    follows[follows] = s[place[follows] - 1] == s[before[follows] - 1]
    wide = np.concatenate((s, np.zeros(4, dtype=np.uint16))).astype(np.uint64)
    four = wide[:n] | wide[1:n + 1] << np.uint64(16) | wide[2:n + 2] << np.uint64(32) | wide[3:n + 3] << np.uint64(48)
    shared = np.zeros(n, dtype=np.int64)
    active, at = np.flatnonzero(~follows & (before >= 0)), 0
    while len(active):          # ends: the closing symbol equals no other
        differ = four[active + at] ^ four[before[active] + at]
        equal = differ == 0
        ended, differ = active[~equal], differ[~equal]
        shared[ended] = at + sum((differ & np.uint64((1 << 16 * k) - 1)) == 0 for k in (1, 2, 3))
        active, at = active[equal], at + 4
    return np.maximum.accumulate(np.where(follows, 0, shared + place)) - place
