"""Suffix arrays by induced sorting, and permuted longest common prefixes, in numpy.

Induced sorting (Nong, Zhang, Chan 2009) scans buckets; here a bucket's entries are taken together. The order inside a
bucket is that of the scan, and entries that a bucket induces into itself (runs of one symbol) follow in rounds. The
substrings between leftmost-smaller positions are named in sorted order; where names repeat, the reduced string of names
is sorted by doubling (its alphabet is too large for buckets), which takes the place of the recursive call.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S); the last symbol must be the one smallest."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    at = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = np.append(step, 1)[np.minimum(nearest, n - 1)] > 0
    return out


def _deal(entries: np.ndarray, text: np.ndarray, queues: dict[int, list[np.ndarray]]) -> None:
    """Append entries to the queues of their symbols, in order."""
    if not len(entries):
        return
    symbol = text[entries]
    order = np.argsort(symbol, kind="stable")
    symbol = symbol[order]
    cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
    for part, c in zip(np.split(entries[order], cuts), symbol[np.append(0, cuts)].tolist(), strict=True):
        queues.setdefault(c, []).append(part)


def _gather(queues: dict[int, list[np.ndarray]], c: int, text: np.ndarray, small: np.ndarray, kind: bool) -> np.ndarray:
    """All entries of bucket c of one type: those dealt so far, then those that they induce into c itself."""
    parts = queues.pop(c, [])
    if not parts:
        return np.zeros(0, np.int64)
    front = np.concatenate(parts)
    found = [front]
    while True:
        before = front[front > 0] - 1
        front = before[(text[before] == c) & (small[before] == kind)]
        if not len(front):
            return np.concatenate(found)
        found.append(front)


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: list[int]) -> np.ndarray:
    """The order of all suffixes that the order of the leftmost-smaller ones (``seeds``) induces."""
    first: dict[int, list[np.ndarray]] = {}
    _deal(seeds, text, first)
    larger: dict[int, np.ndarray] = {}
    queues: dict[int, list[np.ndarray]] = {}
    for c in symbols:
        larger[c] = _gather(queues, c, text, small, False)
        scan = np.concatenate([larger[c], *first.get(c, [])])
        before = scan[scan > 0] - 1
        _deal(before[~small[before] & (text[before] > c)], text, queues)
    out, queues = [], {}
    queues[symbols[0]] = [np.array([len(text) - 1])]
    for c in reversed(symbols):
        rising = _gather(queues, c, text, small, True)
        scan = np.concatenate([rising, larger[c][::-1]])
        before = scan[scan > 0] - 1
        _deal(before[small[before] & (text[before] < c)], text, queues)
        out.append(scan)
    return np.concatenate(out)[::-1]


def _named(text: np.ndarray, ordered: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of leftmost-smaller substrings in sorted order; equal substrings get equal names."""
    a, b = ordered[:-1], ordered[1:]
    length = end[a] - a
    differ = length != end[b] - b
    live = np.flatnonzero(~differ)
    k = 0
    while len(live):
        wrong = text[a[live] + k] != text[b[live] + k]
        differ[live[wrong]] = True
        k += 1
        live = live[~wrong]
        live = live[k <= length[live]]
    return np.append(0, np.cumsum(differ))


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced string, by doubling."""
    rank, h, n = names.astype(np.int64), 1, len(names)
    while True:
        key = rank * (n + 1)
        key[:-h] += rank[h:] + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.append(0, np.cumsum(key[order[1:]] != key[order[:-1]]))
        h *= 2
        if rank[order[-1]] == n - 1 or h >= n:
            return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of an integer text whose last symbol is its one smallest."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    symbols = np.unique(text).tolist()
    first = _induce(text, small, lms, symbols)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    end = np.full(n, n - 1)
    end[lms[:-1]] = lms[1:]
    names = _named(text, ordered, end)
    if names[-1] + 1 < len(lms):
        name_of = np.zeros(n, np.int64)
        name_of[ordered] = names
        ordered = lms[_sorted_names(name_of[lms])]
        return _induce(text, small, ordered, symbols)
    return _induce(text, small, ordered, symbols)


def permuted_lcp(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the order (Karkkainen, Manzini, Puglisi 2009).

    Only where the symbols ahead of the two suffixes differ are symbols compared; elsewhere the value is the one of the
    position before, less one.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    plain = (before < 1) | (at == 0)
    plain[1:] |= text[at[1:] - 1] != text[before[1:] - 1]
    i = np.flatnonzero(plain & (before >= 0))
    j, out = before[i], np.zeros(n, np.int64)
    padded = np.append(text, [-1, -2]).astype(np.int64)
    live, k = np.arange(len(i)), 0
    while len(live):
        same = (i[live] + k < n) & (j[live] + k < n)
        same &= padded[np.minimum(i[live] + k, n)] == padded[np.minimum(j[live] + k, n + 1)]
        out[i[live[~same]]] = k
        live = live[same]
        k += 1
    last = np.maximum.accumulate(np.where(plain, at, 0))
    return np.where(plain, out, np.maximum(0, out[last] - (at - last)))
