"""Periodic runs of words by the tandem-repeat method of Gusfield and Stoye (2004), for a batch of texts at once in numpy.

A run is a stretch of consecutive words that has a smallest period q (words q apart are identical), at least two periods
long, and that no neighbouring word extends keeping that period. The method:

1. The text is cut into Lempel-Ziv blocks: a block is the longest stretch that also starts earlier, or one new word.
2. For each block, common extensions forward and backward find squares that touch its borders. They cover the leftmost
   occurrence of every kind of square (a kind is the string of the square).
3. A kind's next rotation is looked for below its suffix link in the suffix tree, until the rotation doesn't occur or is
   known: with the covering squares this reaches the whole vocabulary of kinds.
4. All occurrences of the kinds, the leaves below their places in the tree, are located, and merge into runs.

The suffix tree is there as its suffix array: a node is an interval, a child the part of it with one next word. A stretch
along which the rotations follow each other in the text is walked in one step, as those are the squares of one run. Names
of all substrings of 2, 4, 8 ... words (Karp, Miller and Rosenberg 1972), from which the suffix array comes too, answer
common extensions. So the work is that of the method times the logarithm of the longest repeated stretch of a text.

A batch holds many texts: the words of a text are symbols of its own, so nothing matches across texts.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

LEAST = 12


class Index:
    """Names of the substrings of 2^k symbols of ``codes``, whose every text ends with a symbol that is nowhere else."""

    def __init__(self, codes: np.ndarray) -> None:
        n = self.n = len(codes)
        order = np.argsort(codes, kind="stable")
        new = np.append(True, codes[order[1:]] != codes[order[:-1]])
        name = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
        name[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.names = [name]
        # Names are places in the sorted order, so that of a substring that is there once never changes again.
        twice = ~new | ~np.append(new[1:], True)
        left, h = order[twice], 1
        while len(left):
            old = name[left].astype(np.int64)
            key = old * n + name[left + h]
            by = np.argsort(key, kind="stable")
            left, key, old = left[by], key[by], old[by]
            at = np.arange(len(left))
            group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
            new = np.append(True, key[1:] != key[:-1])
            name = name.copy()
            name[left] = old + np.maximum.accumulate(np.where(new, at, 0)) - group
            self.names.append(name)
            left = left[~new | ~np.append(new[1:], True)]
            h *= 2
        self.rank = name
        self.order = np.empty(n, np.int64)
        self.order[name] = np.arange(n)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and j (different places) on are the same."""
        out = np.zeros(len(i), np.int64)
        some = np.flatnonzero(self.names[0][i] == self.names[0][j])
        i, j = i[some], j[some]
        top, live = 0, np.arange(len(i))
        while len(live) and top + 1 < len(self.names):
            live = live[self.names[top + 1][i[live]] == self.names[top + 1][j[live]]]
            top += 1
        got = np.zeros(len(i), np.int64)
        for k in range(top, -1, -1):
            name = self.names[k]
            got += (name[i + got] == name[j + got]).astype(np.int64) << k
        out[some] = got
        return out

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to and with i and j (different places, -1 for none) are the same."""
        out = np.zeros(len(i), np.int64)
        some = np.flatnonzero((i >= 0) & (j >= 0) & (self.names[0][i] == self.names[0][j]))
        i, j = i[some] + 1, j[some] + 1
        top, live = 0, np.arange(len(i))
        while len(live) and top + 1 < len(self.names):
            name, h = self.names[top + 1], 1 << (top + 1)
            live = live[(np.minimum(i[live], j[live]) >= h)]
            live = live[name[i[live] - h] == name[j[live] - h]]
            top += 1
        got = np.zeros(len(i), np.int64)
        for k in range(top, -1, -1):
            name, h = self.names[k], 1 << k
            a, b = i - got - h, j - got - h
            got += ((a >= 0) & (b >= 0) & (name[a] == name[b])).astype(np.int64) << k
        out[some] = got
        return out

    def _same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Whether the substrings of this length at i and j are the same; level is the length's logarithm."""
        out = np.empty(len(i), bool)
        room = length - (1 << level)
        for k in np.unique(level):
            if k >= len(self.names):  # there once each
                out[level == k] = i[level == k] == j[level == k]
                continue
            m, name = np.flatnonzero(level == k), self.names[k]
            a, b = i[m], j[m]
            e = np.minimum(np.maximum(a, b) + room[m], self.n - 1) - np.maximum(a, b)
            out[m] = (name[a] == name[b]) & (e == room[m]) & (name[a + e] == name[b + e])
        return out

    def interval(self, i: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in the suffix array of the suffixes that start like the one at i, for so many symbols."""
        level = np.frexp(length.astype(np.float64))[1] - 1
        own = self.rank[i].astype(np.int64)
        ends = []
        for way in (-1, 1):
            near, far = own.copy(), np.full(len(i), -1 if way < 0 else self.n)
            live, step, met = np.arange(len(i)), np.ones(len(i), np.int64), np.zeros(len(i), bool)
            while len(live := live[np.abs(far[live] - near[live]) > 1]):  # gallop till the first other one, then halve
                to = near[live] + way * np.minimum(step[live], np.abs(far[live] - near[live]) - 1)
                same = self._same(i[live], self.order[to], length[live], level[live])
                near[live[same]], far[live[~same]] = to[same], to[~same]
                met[live[~same]] = True
                step[live] = np.where(met[live], np.abs(far[live] - near[live]) // 2, step[live] * 2)
            ends.append(near)
        return ends[0], ends[1]

    def child(self, i: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """A place where the ``length`` symbols at i are followed by the symbol, or -1."""
        first, last = self.interval(i, length)
        low, high = first.copy(), last + 1
        name = self.names[0]
        while (open_ := low < high).any():
            mid = np.minimum((low + high) // 2, last)
            less = open_ & (name[self.order[mid] + length] < symbol)
            low = np.where(less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        at = self.order[np.minimum(low, last)]
        found = low <= last
        found[found] = name[at[found] + length[found]] == symbol[found]
        return np.where(found, at, -1)


def _nearest_earlier(order: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """For each entry of the suffix array the nearest before it that starts earlier in the text; where none of the same
    first symbol does, an entry of another symbol or -1."""
    to = np.arange(len(order)) - 1
    live = np.arange(len(order))
    while len(live):
        live = live[(to[live] >= 0) & (order[to[live]] > order[live])]
        live = live[symbol[to[live]] == symbol[live]]
        to[live] = to[to[live]]
    return to


def _blocks(index: Index) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks."""
    order, n = index.order, index.n
    symbol = index.names[0][order]
    before, after = _nearest_earlier(order, symbol), n - 1 - _nearest_earlier(order[::-1], symbol[::-1])[::-1]
    longest = np.zeros(n, np.int64)
    for near in (before, after):
        there = np.flatnonzero((near >= 0) & (near < n))
        longest[order[there]] = np.maximum(longest[order[there]], index.ahead(order[there], order[near[there]]))
    starts, at, step = [], 0, np.maximum(longest, 1).tolist()
    while at < n:
        starts.append(at)
        at += step[at]
    return np.array(starts)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c: which entry, c times each, and 0 to c - 1 within it."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def _covering(index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of squares that cover the leftmost occurrence of every kind."""
    name, n = index.names[0], index.n
    h = _blocks(index)
    h1 = np.append(h[1:], n)
    h, h1 = h[:-1], h1[:-1]  # the last block is the last text's end
    size = h1 - h
    found = []
    # Squares whose first half starts in the block and whose second half reaches its end or beyond.
    which, k = _spread(size)
    end, k = h1[which], k + 1
    q = end - k
    some = name[end] == name[q]
    end, k, q = end[some], k[some], q[some]
    fore, back = index.ahead(end, q), index.behind(end - 1, q - 1)
    good = fore + back >= k
    found.append((np.maximum(q - back, q - k + 1)[good], k[good]))
    # Squares whose first half starts ahead of the block or at its start, and ends in it.
    which, k = _spread(size + np.append(size[1:], 1))
    start, k = h[which], k + 1
    q = start + k
    some = q < n
    some[some] = name[start[some]] == name[q[some]]
    start, k, q, end = start[some], k[some], q[some], h1[which[some]]
    fore, back = index.ahead(start, q), index.behind(start - 1, q - 1)
    left = np.maximum(start - back, start - k + 1)
    good = (fore + back >= k) & (back > 0) & (left + k <= end)
    found.append((left[good], k[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(index: Index, at: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the runs of squares of half length p at these places, each once."""
    start = at - index.behind(at - 1, at + p - 1)
    end = at + p + index.ahead(at, at + p)
    return np.unique(np.stack([start, end, p], axis=1), axis=0)


def _least_periods(runs: np.ndarray) -> np.ndarray:
    """Of runs over the same stretch the one of the smallest period; sorted by start, end."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))] if len(runs) else runs


def all_runs(codes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in the texts of ``codes``, by start and period."""
    if len(codes) < 3:
        return np.zeros((0, 3), np.int64)
    index = Index(codes)
    known = fresh = _least_periods(_runs(index, *_covering(index)))
    rank, order, n = index.rank, index.order, index.n
    shared = np.append(0, index.ahead(order[1:], order[:-1])) if len(fresh) else np.zeros(0)
    kinds = np.zeros(0, np.int64)
    while len(fresh):
        start, end, p = fresh.T
        # The kinds of a run are its first squares, up to one a rotation; those with an entry beside them occur elsewhere.
        which, off = _spread(np.minimum(p, end - start - 2 * p + 1))
        i, half = start[which] + off, p[which]
        r = rank[i].astype(np.int64)
        again = (shared[r] >= 2 * half) | (np.append(shared, 0)[r + 1] >= 2 * half)
        i, half = i[again], half[again]
        first, last = index.interval(i, 2 * half)
        kind, one = np.unique(first * (n + 1) + half, return_index=True)
        one = one[~np.isin(kind, kinds)]  # each is located once
        kinds = np.append(kinds, kind)
        first, last, half = first[one], last[one], half[one]
        which, off = _spread(last - first + 1)
        at, period = order[first[which] + off], half[which]
        # The rotation after a run's last square, under its suffix link; a run of 3p - 1 symbols has all rotations itself.
        some = end - start < 3 * p - 1
        u, q = (end - 2 * p)[some], p[some]
        to = index.child(u + 1, 2 * q - 1, index.names[0][u])
        at, period = np.append(at, to[to >= 0]), np.append(period, q[to >= 0])
        # Squares inside a known run of their period are no news. Runs of one period are sorted by start and by end.
        by = np.lexsort((known[:, 0], known[:, 2]))
        keys = known[by, 2] * (n + 1) + known[by, 0]
        slot = np.searchsorted(keys, period * (n + 1) + at, side="right") - 1
        inside = (slot >= 0) & (known[by[slot], 2] == period) & (known[by[slot], 1] >= at + 2 * period)
        found = _least_periods(_runs(index, at[~inside], period[~inside]))
        both = _least_periods(np.concatenate([known, found]))
        old = {tuple(x) for x in known.tolist()} if len(found) else set()
        known, fresh = both, both[[tuple(x) not in old for x in both.tolist()] if len(found) else np.zeros(len(both), bool)]
    return known[np.lexsort((known[:, 2], known[:, 0]))]


class _Ids(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: object) -> int:
        self[word] = out = len(self)
        return out


def runs_of_texts(texts: list[list], least: int = LEAST) -> list[np.ndarray]:
    """For each text, a list of words, the rows (start, length, period) of its runs of ``least`` words or more."""
    ids = _Ids()
    sizes = np.array([len(t) for t in texts], np.int64)
    n = int(sizes.sum())
    flat = np.fromiter(map(ids.__getitem__, chain.from_iterable(texts)), np.int64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    codes = np.empty(n + len(texts), np.int64)
    codes[np.arange(n) + text] = text * (len(ids) + 1) + flat
    base = np.cumsum(sizes + 1) - sizes - 1
    codes[base + sizes] = np.arange(1, len(texts) + 1) * (len(ids) + 1) - 1
    found = all_runs(codes)
    found = found[found[:, 1] - found[:, 0] >= np.maximum(least, 2 * found[:, 2])]
    own = np.searchsorted(base, found[:, 0], side="right") - 1
    rows = np.stack([found[:, 0] - base[own], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return np.split(rows, np.searchsorted(own, np.arange(1, len(texts)))) if texts else []
