"""Whole texts to ids of a public tokenizer, by units that the tokenizer's pre-tokenizer never joins.

Most of a byte-pair tokenizer's time goes into words it has met before. Texts are therefore cut at places
where the pre-tokenizer always cuts; each distinct unit is encoded once a task and kept in a bounded
cache. Units of common letters are merged many at a time (``bpe.Merges``), the others go to the library in bulk. Texts whose white space makes such cuts unsafe, or that hold a string of an added token, are encoded whole,
so ids always equal the tokenizer's own.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks already use the cores

from tokenizers import Tokenizer  # noqa: E402

from tidepool.llm import bpe  # noqa: E402

CACHE_UNITS = 400_000
CACHED_CHARS = 64      # longer units are forgotten after the chunk they stand in
BULK = 20_000
BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"    # of ASCII, but space and line feed
CHUNK = 1 << 22        # bytes of text whose units are made distinct at once


class Encoder:
    """``mark`` is a text that stands between units encoded in bulk and gives exactly one id, ``mark_id``, which no unit has.

    ``spaced``: the pre-tokenizer keeps white space (a unit then begins with its space); otherwise it drops it.
    Texts that hold a string of an added token, or a NUL, go to the library whole.
    """

    def __init__(self, path: str, spaced: bool, cache_units: int = CACHE_UNITS):
        self.cache_units = cache_units
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.firsts = ["\0", *sorted({t[0] for t in added})]
        self.added = re.compile("|".join(["\0", *map(re.escape, added)])).search
        self.spaced = spaced
        self.cut = "\0" if spaced else " "
        self.mark = "\n" if spaced else " 0 "
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # white space other than single spaces and line feeds: runs of it are cut by rules that look beyond a unit
        self.blank = re.compile(r"[^\S \n]").search
        self.space_run = re.compile(r" \s|\s ").search
        # a comma or full stop is a token of its own only after a letter or digit and before white space
        self.joined = re.compile(r"[,.](?<![^\W_][,.])(?=\s|\Z)").search
        # one word of letters that every Unicode version knows, which no normalisation changes but to lower case
        self.plain = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿА-Яа-яЁё]+" if spaced else "[A-Za-zÀ-ÖØ-öø-ÿА-Яа-яЁё]+").fullmatch
        self.merges = bpe.Merges(path)
        self.merges.data = self.merges.ids = None      # the file's tokens are the library's matter here
        self.bulk_safe = re.compile(r" ?[^\s]+" if spaced else r"[^\s0]+").fullmatch
        self.clear()

    def clear(self) -> None:
        """Forget all units; the empty one has no ids."""
        self.place: dict[str, int] = {"": 0}
        self.pool, self.size, self.at = np.zeros(0, self.dtype), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def whole(self, text: str) -> bool:
        """Whether a text holds a string of an added token, or a NUL."""
        return any(c in text for c in self.firsts) and bool(self.added(text))

    def other_space(self, text: str) -> bool:
        """Whether a text holds white space other than spaces and line feeds."""
        return any(c in text for c in BLANKS) if text.isascii() else bool(self.blank(text))

    def unsafe(self, text: str) -> bool:
        """Whether a space stands next to other white space."""
        return "  " in text or " \n" in text or "\n " in text or bool(self.other_space(text) and self.space_run(text))

    def marked(self, text: str) -> str:
        """The text with ``cut`` between parts (some empty) whose ids, put together, are the text's."""
        if self.spaced:
            if self.unsafe(text):
                return text
            if "\n\n" in text or self.joined(text) or self.other_space(text):
                return text.replace(" ", "\0 ")
            text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
            return text.replace(",\0", "\0,\0").replace(".\0", "\0.\0")
        text = text.replace("\n", " ")
        if not self.joined(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text

    def _keep(self, found: list[tuple[list[str], np.ndarray, np.ndarray]]) -> None:
        """(units, their ids one after another, ids a unit), many at once: the arrays are copied once."""
        units = [u for f in found for u in f[0]]
        size = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
        n = len(self.place)
        self.place.update(zip(units, range(n, n + len(units)), strict=True))
        self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, *(f[1].astype(self.dtype) for f in found)])

    def learn(self, units: list[str]) -> None:
        plain, other, found = [], [], []
        for u in units:
            (plain if len(u) <= CACHED_CHARS and self.plain(u) else other).append(u)
        raw = [u.encode() for u in (plain if self.spaced else [u.lower() for u in plain])]
        for rows, table, size in bpe.by_width(raw, 2 * CACHED_CHARS + 1):
            for lo in range(0, len(rows), BULK):       # the steps' arrays stay small
                part = slice(lo, lo + BULK)
                found.append(([plain[i] for i in rows[part].tolist()], *self.merges.merge_step(table[part], size[part])))
        safe = [u for u in other if self.bulk_safe(u)]
        for lo in range(0, len(safe), BULK):
            part = safe[lo:lo + BULK]
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark + self.mark.join(part)], add_special_tokens=False)[0].ids, np.uint32)
            mark = ids == self.mark_id
            cut = np.append(np.flatnonzero(mark), len(ids))
            if len(cut) != len(part) + 1:
                raise ValueError("units and marks do not match")
            found.append((part, ids[~mark], np.diff(cut) - 1))
        rest = [u for u in other if not self.bulk_safe(u)]
        if rest:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            found.append((rest, np.array([i for f in ids for i in f], np.uint32), np.array([len(f) for f in ids])))
        self._keep(found)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        whole = {i for i, t in enumerate(texts) if self.whole(t)}
        cut = pc.split_pattern(pa.array(["" if i in whole else self.marked(t) for i, t in enumerate(texts)], pa.large_string()), self.cut)
        units = cut.flatten().dictionary_encode()
        distinct = units.dictionary.to_numpy(zero_copy_only=False).tolist()      # quicker than to_pylist
        place = list(map(self.place.get, distinct))
        new = [u for u, k in zip(distinct, place, strict=True) if k is None]
        if len(self.place) + len(new) > self.cache_units:
            self.clear()
            new, place = [u for u in distinct if u], [None if u else 0 for u in distinct]
        long = [u for u in new if len(u) > CACHED_CHARS]
        if new:
            self.learn([u for u in new if len(u) <= CACHED_CHARS])
        known, held = len(self.place), len(self.pool)
        if long:
            self.learn(long)
        learnt = map(self.place.__getitem__, new)
        place = np.fromiter((next(learnt) if k is None else k for k in place), np.int64, len(place))
        own = pa.LargeListArray.from_arrays(pa.array(np.append(self.at, len(self.pool))), pa.array(self.pool))
        taken = own.take(pa.array(place).take(units.indices))
        ids, bounds = taken.flatten().to_numpy(), taken.offsets.to_numpy()[cut.offsets.to_numpy()]
        if long:
            for u in long:
                del self.place[u]
            self.pool, self.size, self.at = self.pool[:held].copy(), self.size[:known].copy(), self.at[:known].copy()
        return [np.array(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, self.dtype) if i in whole else ids[a:b]
                for i, (t, a, b) in enumerate(zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool, cache_units: int = CACHE_UNITS) -> Encoder:
    """One encoder a Python worker. A task clears it when it ends (a cached unit takes about 200 bytes), so idle workers hold none."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced, cache_units)
    return _encoders[path, spaced]
