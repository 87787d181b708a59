"""Surface statistics of whole texts, computed from hashed words a block at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidepool.llm import common as C

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_POINT = np.ones(256, bool)      # bytes that begin a code point
_POINT[0x80:0xC0] = False
WINDOW = 3


def repeated_words(block: C.Block) -> np.ndarray:
    """Per text: words inside a 3-word window that stands twice or more in it."""
    at, key = block.shingles(WINDOW)
    key = C.mix(key ^ (block.owner[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(block.words), bool)
    for i in range(WINDOW):
        covered[at[twice] + i] = True
    return C.sums(covered, block.first)


def line_counts(block: C.Block) -> tuple[np.ndarray, np.ndarray]:
    """Per text: its lines that hold a word, and those equal to an earlier one."""
    end = np.flatnonzero(block.bytes == 10)          # every text ends in an added line feed
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    words = np.searchsorted(block.start, end) - np.searchsorted(block.start, start)
    start, end = start[words > 0], end[words > 0]
    owner = np.searchsorted(block.doc_start, start, side="right") - 1
    key = C.mix(C.byte_hashes(block.padded, start, end) ^ (owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    _, first = np.unique(key, return_index=True)
    dup = np.ones(len(key), np.int64)
    dup[first] = 0
    return np.bincount(owner, minlength=block.n), np.bincount(owner, weights=dup, minlength=block.n).astype(np.int64)


def measure(texts: list[bytes]) -> list[np.ndarray]:
    """The arrays of ``FIELDS``, one value a text."""
    block = C.Block(texts)
    points = _POINT[block.bytes] & ~C.SPACE[block.bytes]
    lines, dups = line_counts(block)
    return [block.n_words, C.sums(points, block.doc_start), C.sums(_SYMBOL[block.bytes], block.doc_start),
            dups, repeated_words(block), lines]


def add_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column ``text`` by the statistics of ``FIELDS``."""
    for batch in batches:
        parts = [measure(t) for _, _, t in C.chunks(batch)]
        keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        columns = [batch.column(i) for i in keep]
        for k in range(len(FIELDS)):
            values = np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
            columns.append(pa.array(values, pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[i] for i in keep] + list(FIELDS))
