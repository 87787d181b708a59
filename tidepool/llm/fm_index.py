"""An FM-index over sequences of numbers: suffix order, wavelet matrix with rank directories, backward search.

All queries of a batch advance together, one symbol a step, as numpy arrays.
"""

from __future__ import annotations

import numpy as np


class Ranks:
    """Bits packed in 64-bit words with a count before each word: ones before a place in constant time."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(ones, dtype=np.int32) - ones
        self.zeros = len(bits) - int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class Minimum:
    """Least value of any range: per-block prefix and suffix minima and a sparse table over blocks of 16."""

    B = 16

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // self.B) * self.B
        self.top = np.iinfo(np.int32).max
        self.values = np.full(n, self.top, np.int32)
        self.values[:len(values)] = values
        square = self.values.reshape(-1, self.B)
        self.left = np.minimum.accumulate(square, axis=1).ravel()
        self.right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [square.min(axis=1)]
        while 2 * (half := 1 << (len(self.table) - 1)) <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))
        self.size = max(map(len, self.table), default=0)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of the non-empty ranges [lo, hi)."""
        end = hi - 1
        first, last = lo // self.B, end // self.B
        out = np.minimum(self.right[lo], self.left[end])
        same = np.flatnonzero(first == last)
        if len(same):
            span = lo[same][:, None] + np.arange(self.B)
            inside = np.where(span < hi[same][:, None], self.values[np.minimum(span, len(self.values) - 1)], self.top)
            out[same] = inside.min(axis=1)
        wide = np.flatnonzero(last - first > 1)
        if len(wide):
            a, b = first[wide] + 1, last[wide]
            level = np.frexp((b - a).astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                w = level == k
                out[wide[w]] = np.minimum(out[wide[w]], np.minimum(self.table[k][a[w]], self.table[k][b[w] - (1 << k)]))
        return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` sorted by their next ``depth`` (a power of two) symbols, by doubling."""
    n = len(text)
    rank = text.astype(np.int64)
    span = 1
    while True:
        follow = np.zeros(n, np.int64)
        if span < n:
            follow[:-span] = rank[span:] + 1
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        span *= 2
        if span >= depth or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Index of several sequences (symbols from 1; 0 ends each), each with an owner's rank; patterns up to ``depth`` long."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, symbols: int, depth: int = 128):
        zero = np.zeros(1, np.int64)
        text = np.concatenate([p for s in sequences for p in (s, zero)])
        owner = np.repeat(owners, [len(s) + 1 for s in sequences])
        order = suffix_order(text, depth)
        bwt = text[order - 1]
        self.least = Minimum(owner[order])
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.levels = []
        for bit in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            bits = (bwt >> bit) & 1 == 1
            self.levels.append((bit, Ranks(bits)))
            bwt = np.concatenate([bwt[~bits], bwt[bits]])
        every = np.arange(symbols + 1)
        self.origin = self._descend(every, np.zeros(symbols + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ranks in self.levels:
            ones = ranks.ones(at)
            at = np.where((symbol >> bit) & 1, ranks.zeros + ones, at - ones)
        return at

    def first(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.start[symbol], self.start[symbol + 1]

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol put in front."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        both += np.concatenate([self.start[symbol] - self.origin[symbol]] * 2)
        return both[:len(symbol)], both[len(symbol):]


def covered(index: FMIndex, queries: list[np.ndarray], ranks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, from, to) of matches of at least ``width`` symbols that an owner of smaller rank has; together they
    cover just the windows of ``width`` symbols that such an owner has.

    An attempt goes from an end ``e`` to the left until the match breaks at ``g`` (-1: it never does): then no window
    that holds g..e matches. ``u`` is the last place where a window can still end. Attempts begin at ``u``;
    after a break the next one begins eight symbols into the last window, so that a foreign word ends it after
    few steps and rules all windows over it out, and moves right in growing steps only while it gets through.
    """
    n = len(queries)
    flat = np.concatenate(queries) if n else np.zeros(0, np.int64)
    size = np.array([len(q) for q in queries], np.int64)
    base = np.cumsum(size) - size
    u = size - 1
    e, pos, step = u.copy(), u.copy(), np.full(n, 8)
    lo, hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    active = np.flatnonzero(u >= width - 1)
    while len(active):
        symbol = flat[base[active] + pos[active]]
        fresh = pos[active] == e[active]
        a, b = index.first(symbol)
        old = ~fresh
        if old.any():
            a[old], b[old] = index.extend(symbol[old], lo[active][old], hi[active][old])
        lo[active], hi[active] = a, b
        good = b > a
        some = np.flatnonzero(good)
        good[some] = index.least.of(a[some], b[some]) < ranks[active[some]]
        pos[active[good]] -= 1
        over = active[~good | (pos[active] < 0)]
        if len(over):
            g = pos[over]                               # a match that reached the beginning has -1 here
            long = e[over] - g >= width
            if long.any():
                out.append((over[long], g[long] + 1, e[over][long] + 1))
            last = u[over] - width + 1
            dead, full = g >= last, e[over] == u[over]
            further = over[~dead & ~full]
            e[further] = np.minimum(u[further], e[further] + step[further])
            step[further] *= 2
            u[over[dead]] = e[over[dead]] - 1
            through = ~dead & full
            u[over[through]] = g[through] + width - 1
            moved = over[dead | full]
            step[moved] = 8
            e[moved] = np.minimum(u[moved], np.maximum(0, u[moved] - width + 1) + 7)
            pos[over] = e[over]
            active = active[u[active] >= width - 1]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))
