"""A minimal acyclic transducer from words (bytes) to id sequences, as flat arrays in one file that tasks map.

Words come sorted. Each new word shares its prefix with the one before; states below that prefix can no longer
change and are frozen: one that accepts the same endings with the same ids as a frozen state is replaced by it,
so suffixes are shared. Ids move along the edges towards the start as far as the words through an edge agree.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

ARRAYS = ("first", "label", "target", "out_at", "out_n", "final", "final_at", "final_n", "pool")


class _State:
    __slots__ = ("edges", "final", "last")

    def __init__(self):
        self.edges: list[list] = []      # [byte, state or frozen number, ids]; labels rise
        self.final = False
        self.last: tuple = ()            # ids given where a word ends here


def _shared(a: tuple, b: tuple) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


def compile_words(pairs: Iterable[tuple[bytes, tuple]]) -> dict[str, np.ndarray]:
    """The transducer of (word, ids) pairs with distinct words in rising order."""
    frozen: dict[tuple, int] = {}
    path = [_State()]
    before = b""

    def freeze(depth: int) -> None:
        """Freezes the open states below ``depth`` of the path."""
        while len(path) > depth + 1:
            s = path.pop()
            key = (s.final, s.last, tuple((b, t, o) for b, t, o in s.edges))
            path[-1].edges[-1][1] = frozen.setdefault(key, len(frozen))

    for word, ids in pairs:
        if word <= before and (before or path[0].final):
            raise ValueError("words must be distinct and sorted")
        depth = 0
        while depth < min(len(word), len(before)) and word[depth] == before[depth]:
            depth += 1
        freeze(depth)
        for s in path[:depth]:
            edge = s.edges[-1]
            n = _shared(edge[2], ids)
            surplus, edge[2], ids = edge[2][n:], edge[2][:n], ids[n:]
            if surplus:
                below = edge[1]
                for e in below.edges:
                    e[2] = surplus + e[2]
                if below.final:
                    below.last = surplus + below.last
        for b in word[depth:]:
            new = _State()
            path[-1].edges.append([b, new, ids])
            path.append(new)
            ids = ()
        path[-1].final, path[-1].last = True, ids
        before = word
    freeze(0)
    root = path[0]
    states = [*frozen, (root.final, root.last, tuple((b, t, o) for b, t, o in root.edges))]
    pool: list[int] = []
    places: dict[tuple, int] = {(): 0}

    def place(ids: tuple) -> int:
        if ids not in places:
            places[ids] = len(pool)
            pool.extend(ids)
        return places[ids]

    edges = [e for s in states for e in s[2]]
    return {"first": np.cumsum([0] + [len(s[2]) for s in states]).astype("<u4"),
            "label": np.array([e[0] for e in edges], "u1"), "target": np.array([e[1] for e in edges], "<u4"),
            "out_at": np.array([place(e[2]) for e in edges], "<u4"), "out_n": np.array([len(e[2]) for e in edges], "<u4"),
            "final": np.array([s[0] for s in states], "u1"),
            "final_at": np.array([place(s[1]) for s in states], "<u4"), "final_n": np.array([len(s[1]) for s in states], "<u4"),
            "pool": np.array(pool, "<u4")}


def to_bytes(arrays: dict[str, np.ndarray], extra: dict) -> bytes:
    head, at = {}, 0
    for name in ARRAYS:
        head[name] = (at, arrays[name].dtype.str, len(arrays[name]))
        at += -(-arrays[name].nbytes // 8) * 8
    text = json.dumps({"arrays": head, "extra": extra}).encode()
    text += b" " * (-len(text) % 8)
    body = b"".join(arrays[n].tobytes() + bytes(-arrays[n].nbytes % 8) for n in ARRAYS)
    return len(text).to_bytes(8, "little") + text + body


class Transducer:
    """The mapped file; many words are looked up in step, one byte of all of them at a time."""

    def __init__(self, data: np.ndarray):
        n = int(data[:8].view("<u8")[0])
        head = json.loads(data[8:8 + n].tobytes())
        self.extra = head["extra"]
        for name, (at, kind, size) in head["arrays"].items():
            begin = 8 + n + at
            setattr(self, name, data[begin:begin + size * np.dtype(kind).itemsize].view(kind))
        states = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first.astype(np.int64)))
        self.keys = states * 256 + self.label                       # rise, since labels rise inside a state
        self.root = len(self.first) - 2

    @classmethod
    def open(cls, path: str) -> Transducer:
        return cls(np.memmap(path, np.uint8, mode="r"))

    def lookup(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, ids of the found words one after another, ids a found word) of words given as rows of bytes."""
        n, width = words.shape
        state = np.full(n, self.root, np.int64)
        at, size = np.zeros((n, width + 1), np.int64), np.zeros((n, width + 1), np.int64)
        live, ended = np.arange(n), np.zeros(n, bool)
        for p in range(width + 1):
            over = lengths[live] == p
            ended[live[over]] = True
            live = live[~over]
            if not len(live) or p == width or not len(self.keys):
                break
            key = state[live] * 256 + words[live, p]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[edge] == key
            live, edge = live[ok], edge[ok]
            state[live] = self.target[edge]
            at[live, p], size[live, p] = self.out_at[edge], self.out_n[edge]
        found = ended & (self.final[state] > 0)
        at[found, width], size[found, width] = self.final_at[state[found]], self.final_n[state[found]]
        return found, gather(self.pool, at[found].ravel(), size[found].ravel()), size[found].sum(axis=1)


def gather(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``pool[at[i]:at[i] + size[i]]`` of every i, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(at - ends + size, size)]
