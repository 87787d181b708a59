"""Phrase collocation mining by Rabin-Karp fingerprints of every n-gram.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words ``[^\\x20\\x09]+``. A task hashes all
n-grams of a chunk of texts at once: prefix sums of byte times power of a base modulo 2**61 - 1 give the polynomial
of any byte range by one subtraction. The language is part of the fingerprint, so one language with most rows is
spread like any other. A task counts its own fingerprints first (``HELD`` at a time); a shuffle by fingerprint adds
the counts and keeps one occurrence pointer each: (hash of language and text, number of the phrase's first word).
Only phrases found ``least`` times or more are then read from their texts, once, at their pointers.

Fingerprints that meet by chance are told apart: each comes with a check, an independent 32-bit hash of the words.
Counts are kept by both, so two phrases with one fingerprint keep a pointer each, their texts are read, and every
text is held against the fingerprint and the check it was read for.

Words and pairs are counted in one pass. Longer phrases follow in one pass a length, and only those whose first and
last part were found often enough are hashed; a bitmap of these parts' fingerprints says which (``BITS`` bits at most;
where it fills up it lets more phrases through and the results stay the same).

Null text: empty; null lang: ``und``; a row without text or words adds nothing. Repeated rows count as often as they
stand. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common as C

LEAST = 10             # occurrences that make a phrase a candidate
LONGEST = 3            # words of a phrase
COVER = 50             # per cent of a phrase's occurrences inside a longer one that drop it
TOP = 2000             # phrases returned a language
HELD = 1 << 19         # fingerprints a task holds before it counts equal ones together
BITS = 1 << 28         # bound of the bitmap of frequent parts (32 MB)
SALTS = 32             # parts in which a language's best are found first
LONG_WORD = 4096       # bytes; a longer word is hashed by its digest
SLICES = 8             # buckets a reducing task handles one after another

PRIME = np.uint64((1 << 61) - 1)
BASE = 0x1F3A5C97D2E4B681 % ((1 << 61) - 1)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)

_CUT = np.zeros(256, bool)                # bytes that end a piece
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = np.zeros(256, bool)              # bytes that end a word inside a piece
_BLANK[[0x20, 0x09]] = True
_WORD = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+")
_LONG = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]{%d,}" % (LONG_WORD + 1))

FREQUENT = "fp long, check int, words int, n long, key long, at int"


# ------------------------------------------------------------------ fingerprints

def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo 2**61 - 1, for any 64-bit numbers."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of numbers below it; 2**62 is 2 and 2**61 is 1 there."""
    ah, al = a >> np.uint64(31), a & _LOW31
    bh, bl = b >> np.uint64(31), b & _LOW31
    mid = ah * bl + al * bh
    return reduced((ah * bh << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & _LOW30) << np.uint64(31)) + al * bl)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """At least the first ``n`` powers of ``base``, by doubling."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, times(have, np.uint64(pow(base, len(have), int(PRIME))))])
    _powers[base] = have
    return have


_INVERSE = pow(BASE, -1, int(PRIME))


class Grams:
    """Words of some texts in one array, blanks between them made one, and the fingerprints of their n-grams."""

    def __init__(self, texts: list[bytes], names: np.ndarray):
        """``names``: a 64-bit number for each text, part of all its fingerprints."""
        self.n = len(texts)
        self._read(texts)
        if len(self.size) and self.size.max() > LONG_WORD:
            self._read([_LONG.sub(_digest, t.lower()) for t in texts])
        self.first = np.searchsorted(self.word, self.bounds)         # words before each text
        self.owner = np.repeat(np.arange(self.n), np.diff(self.first))
        self.number = np.arange(len(self.word)) - self.first[self.owner]
        self.name = names[self.owner]
        padded = np.concatenate([self.line, np.zeros(8, np.uint8)])
        self.words = C.byte_hashes(padded, self.start, self.start + self.size)
        power = powers(BASE, len(self.line) + 1)[:len(self.line)]
        code = self.line.astype(np.uint64) + np.uint64(1)
        zero = np.zeros(1, np.uint64)
        # both sums may wrap: only differences over one phrase are used, and these are below 2**64
        self.low = np.concatenate([zero, np.cumsum(code * (power & _LOW31), dtype=np.uint64)])
        self.high = np.concatenate([zero, np.cumsum(code * (power >> np.uint64(31)), dtype=np.uint64)])

    def _read(self, texts: list[bytes]) -> None:
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        raw = C.LOWER[np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", np.uint8)]
        cut = _CUT[raw]
        gap = cut | _BLANK[raw]
        edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
        self.word = np.flatnonzero(edge == -1)                       # where words begin in the raw bytes
        end = np.flatnonzero(edge == 1)
        self.size = end - self.word
        self.piece = np.cumsum(cut)[self.word] if len(self.word) else self.word
        kept = ~gap
        kept[end] = True                                             # one byte after each word, as a blank
        self.line = np.where(gap, np.uint8(0x20), raw)[kept]
        self.start = np.concatenate([[0], np.cumsum(self.size + 1)])[:-1]

    def runs(self, k: int) -> np.ndarray:
        """First words of all runs of ``k`` words inside one piece."""
        at = np.arange(max(0, len(self.word) - k + 1))
        return at if k == 1 else at[self.piece[at] == self.piece[at + k - 1]]

    def fingerprints(self, at: np.ndarray, k: int) -> np.ndarray:
        begin, end = self.start[at], self.start[at + k - 1] + self.size[at + k - 1]
        low = reduced(self.low[end] - self.low[begin])
        high = reduced(self.high[end] - self.high[begin])
        value = reduced((high >> np.uint64(30)) + ((high & _LOW30) << np.uint64(31)) + low)
        value = times(value, powers(_INVERSE, len(self.line) + 1)[begin])
        return reduced(value + reduced(self.name[at]))

    def checks(self, at: np.ndarray, k: int) -> np.ndarray:
        return (C.chain([self.name[at]] + [self.words[at + i] for i in range(k)]) >> np.uint64(32)).astype(np.uint32)


def _digest(m: re.Match) -> bytes:
    return b"\0" + hashlib.blake2b(m.group().lower(), digest_size=16).hexdigest().encode()


def _names(langs: list[str]) -> np.ndarray:
    data = [x.encode() for x in langs]
    padded = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
    end = np.cumsum([len(x) for x in data], dtype=np.int64)
    return C.byte_hashes(padded, end - np.fromiter(map(len, data), np.int64, len(data)), end)


# ------------------------------------------------------------------ counting

RECORD = (("fp", "<u8"), ("check", "<u4"), ("words", "u1"), ("n", "<u4"), ("key", "<u8"), ("at", "<u4"))


def _blank() -> dict[str, list[np.ndarray]]:
    return {name: [] for name, _ in RECORD}


def counted(parts: dict[str, list[np.ndarray]]) -> dict[str, np.ndarray]:
    """Equal (fingerprint, check) made one: counts added, the least pointer kept; sorted by fingerprint."""
    a = {name: np.concatenate(parts[name]) if parts[name] else np.zeros(0, kind) for name, kind in RECORD}
    if not len(a["fp"]):
        return a
    order = np.argsort(a["fp"], kind="stable")
    a = {name: v[order] for name, v in a.items()}
    same = a["fp"][1:] == a["fp"][:-1]
    if np.any(same & (a["check"][1:] != a["check"][:-1])):           # fingerprints that met by chance
        order = np.lexsort([a["check"], a["fp"]])
        a = {name: v[order] for name, v in a.items()}
        same = (a["fp"][1:] == a["fp"][:-1]) & (a["check"][1:] == a["check"][:-1])
    begin = np.flatnonzero(np.concatenate([[True], ~same]))
    out = {name: a[name][begin] for name, _ in RECORD}
    out["n"] = np.add.reduceat(a["n"].astype(np.int64), begin)
    out["key"] = np.minimum.reduceat(a["key"], begin)
    least = a["key"] == np.repeat(out["key"], np.diff(np.append(begin, len(same) + 1)))
    out["at"] = np.minimum.reduceat(np.where(least, a["at"], np.uint32(0xFFFFFFFF)), begin)
    return out


def _blobs(found: dict[str, np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """A binary value for each bucket that has fingerprints: column after column, keys by their place in a list."""
    cut = np.searchsorted(C.unpack(found["fp"] << np.uint64(3), width), np.arange(width + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cut))
    values = []
    for i in some.tolist():
        part = {name: v[cut[i]:cut[i + 1]] for name, v in found.items()}
        keys, place = np.unique(part["key"], return_inverse=True)
        head = np.array([len(part["fp"]), len(keys)], "<u4").tobytes()
        values.append(head + keys.tobytes() + place.astype("<u2" if len(keys) <= 1 << 16 else "<u4").tobytes()
                      + part["fp"].tobytes() + part["check"].tobytes() + part["words"].tobytes()
                      + part["n"].astype("<i8").tobytes() + part["at"].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([None] * len(some), pa.string()), pa.array([0] * len(some), pa.int64()),
                                      pa.array(values, pa.binary())], names=["bucket", "lang", "total", "grams"])


def _opened(blob: bytes) -> dict[str, np.ndarray]:
    n, m = np.frombuffer(blob, "<u4", 2).tolist()
    at, out = 8, {}

    def take(kind, count):
        nonlocal at
        got = np.frombuffer(blob, kind, count, at)
        at += got.nbytes
        return got
    keys = take("<u8", m)
    out["key"] = keys[take("<u2" if m <= 1 << 16 else "<u4", n)]
    for name, kind in (("fp", "<u8"), ("check", "<u4"), ("words", "u1"), ("n", "<i8"), ("at", "<u4")):
        out[name] = take(kind, n)
    return out


def _counts(sizes: tuple[int, ...], width: int, parts: np.ndarray | None, totals: bool, bits: int):
    """Counts of a task's n-grams of the given sizes, and (with ``totals``) its words by language."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, words = _blank(), 0, {}
        for batch in batches:
            langs, keys = batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64)
            for lo, hi, texts in C.chunks(batch):
                grams = Grams(texts, _names(langs[lo:hi]))
                if totals:
                    for name, n in zip(langs[lo:hi], np.diff(grams.first).tolist(), strict=True):
                        words[name] = words.get(name, 0) + n
                for k in sizes:
                    at = grams.runs(k)
                    if parts is not None:
                        known = np.zeros(len(grams.word), bool)
                        inner = grams.runs(k - 1)
                        known[inner] = C.in_bitmap(parts, grams.fingerprints(inner, k - 1) & mask)
                        at = at[known[at] & known[at + 1]]
                    held["fp"].append(grams.fingerprints(at, k) & mask)
                    held["check"].append(grams.checks(at, k))
                    held["words"].append(np.full(len(at), k, np.uint8))
                    held["n"].append(np.ones(len(at), np.uint32))
                    held["key"].append(keys[lo:hi][grams.owner[at]])
                    held["at"].append(grams.number[at].astype(np.uint32))
                    size += len(at)
                if size >= HELD:
                    found = counted(held)
                    held, size = {name: [v] for name, v in found.items()}, len(found["fp"])
                    if size >= HELD // 2:
                        yield from _blobs(found, width)
                        held, size = _blank(), 0
        yield from _blobs(counted(held), width)
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array([i % width for i in range(len(words))], pa.int32()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64()),
                 pa.array([None] * len(words), pa.binary())], names=["bucket", "lang", "total", "grams"])
    return run


def _frequent(least: int):
    """Adds the counts of a bucket's fingerprints; only those found ``least`` times or more go on."""
    def rows(found, lang=None, total=None):
        n = len(found["fp"]) if found else len(lang)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(found["fp"].view(np.int64)), pa.array(found["check"].view(np.int32)), pa.array(found["words"].astype(np.int32)),
             pa.array(found["n"].astype(np.int64)), pa.array(found["key"].view(np.int64)), pa.array(found["at"].view(np.int32)),
             pa.nulls(n, pa.string())] if found else
            [none, none.cast(pa.int32()), none.cast(pa.int32()), pa.array(total, pa.int64()), none, none.cast(pa.int32()), pa.array(lang, pa.string())],
            names=["fp", "check", "words", "n", "key", "at", "lang"])

    def merged(held):
        found = counted(held)
        often = found["n"] >= least
        return rows({name: v[often] for name, v in found.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, size, langs, most = _blank(), None, 0, {}, 2 * HELD
        for batch in batches:
            for b, lang, total, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if blob is None:
                    langs[lang] = langs.get(lang, 0) + total
                    continue
                if b != bucket:
                    if size:
                        yield merged(held)
                    held, bucket, size, most = _blank(), b, 0, 2 * HELD
                for name, v in _opened(blob).items():
                    held[name].append(v)
                size += len(held["fp"][-1])
                if size >= most:                                      # equal ones of many tasks are made one
                    held = {name: [v] for name, v in counted(held).items()}
                    size = len(held["fp"][0])
                    most = max(2 * HELD, 2 * size)
        if size:
            yield merged(held)
        if langs:
            yield rows(None, list(langs), list(langs.values()))
    return run


def _mined(docs: DataFrame, sizes: tuple[int, ...], least: int, bits: int, parts: np.ndarray | None = None) -> DataFrame:
    """Frequent n-grams (and, with sizes from 1, rows of word totals a language), settled."""
    width = C.shuffle_width(docs.sparkSession) * SLICES
    sent = docs.mapInArrow(_counts(sizes, width, parts, 1 in sizes, bits), "bucket int, lang string, total long, grams binary")
    dealt = sent.repartition(C.shuffle_width(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
    return C.settle(dealt.mapInArrow(_frequent(least), FREQUENT + ", lang string"))


def _bits_for(n: int) -> int:
    return min(BITS, max(1 << 15, 1 << (16 * n).bit_length())).bit_length() - 1


# ------------------------------------------------------------------ texts of frequent phrases

def _wanted(found: np.ndarray):
    """Only texts whose key is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = C.in_bitmap(found, batch.column(1).to_numpy().view(np.uint64))
            if keep.any():
                yield batch.filter(pa.array(keep))
    return run


def _phrases(bits: int):
    """The phrases at a text's pointers; one whose fingerprint or check differs belongs to another text with this key."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()
            lists = batch.column("pointers").to_pylist()
            out = []
            for lang, text, pointers in zip(langs, texts, lists, strict=True):
                words = _WORD.findall(text.lower())
                out += [(lang, b" ".join(words[p["at"]:p["at"] + p["words"]]), p) for p in pointers if p["at"] + p["words"] <= len(words)]
            if not out:
                continue
            grams = Grams([o[1] for o in out], _names([o[0] for o in out]))
            size = np.array([o[2]["words"] for o in out])
            ok = np.diff(grams.first) == size
            for k in set(size[ok].tolist()):
                here = np.flatnonzero(ok & (size == k))
                at = grams.first[here]
                fp = np.array([out[i][2]["fp"] for i in here], np.int64).view(np.uint64)
                check = np.array([out[i][2]["check"] for i in here], np.int32).view(np.uint32)
                ok[here] = (grams.fingerprints(at, k) & mask == fp) & (grams.checks(at, k) == check)
            kept = [out[i] for i in np.flatnonzero(ok)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in kept], pa.string()), pa.array([o[1].decode("utf-8", "replace") for o in kept], pa.string()),
                 pa.array([o[2]["words"] for o in kept], pa.int32()), pa.array([o[2]["n"] for o in kept], pa.int64())], names=["lang", "phrase", "words", "n"])
    return run


def _materialised(docs: DataFrame, frequent: DataFrame, bits: int) -> DataFrame:
    """(lang, phrase, words, n) of the frequent phrases. Each is read from one text, so a text's list is at most its n-grams."""
    pointers = frequent.groupBy("key").agg(F.collect_list(F.struct("fp", "check", "words", "n", "at")).alias("pointers"))
    keys = frequent.select("key").distinct()
    found = C.bitmap(keys, "key", _bits_for(keys.count()))
    texts = docs.mapInArrow(_wanted(found), docs.schema).groupBy("key").agg(F.first(F.struct("lang", "text")).alias("t"))
    return C.settle(texts.join(pointers, "key").select("t.lang", "t.text", "pointers").mapInArrow(
        _phrases(bits), "lang string, phrase string, words int, n long"))


# ------------------------------------------------------------------ scores

def scored(phrases: DataFrame, totals: DataFrame, cover: int = COVER) -> DataFrame:
    """Candidates that no longer one covers: lang, phrase, a, l, r, n and the score of their weakest cut."""
    many = phrases.filter("words > 1")
    parts = F.split("phrase", " ", -1)
    cuts = many.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumns(
        {"left": F.concat_ws(" ", F.slice(parts, 1, F.col("k"))), "right": F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.size(parts)))})
    one = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = (cuts.join(one.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
            .join(one.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"]))
    wide = "cast({} as decimal(38, 0))".format
    cuts = cuts.withColumn("score", F.expr(f"({wide(1000000)} * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c"))
    # the parts of a longer candidate, first to last, and the most often found one that has them
    longest = F.expr("""flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),
                        i -> concat_ws(' ', slice(split(phrase, ' ', -1), i, m)))))""")
    inner = (phrases.filter("words > 2").select("lang", "n", F.explode(F.array_distinct(longest)).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    kept = best.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("c.a")))
    return kept.join(totals, "lang").select("lang", "phrase", "c.a", "c.l", "c.r", "n", "c.score")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: int = COVER, bits: int = 61) -> DataFrame:
    """All scored collocations of ``documents``. ``bits``: those of a fingerprint that are used (fewer in tests)."""
    C.small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = rows.select("lang", F.xxhash64("lang", "text").alias("key"), "text")
    found = _mined(rows, (1, 2), least, bits)
    totals = found.filter("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = found.filter("lang is null").drop("lang")
    for k in range(3, longest + 1):
        parts = frequent.filter(F.col("words") == k - 1).select("fp")
        more = _mined(rows, (k,), least, bits, C.bitmap(parts, "fp", _bits_for(parts.count())))
        frequent = frequent.unionByName(more.drop("lang"))
    return scored(_materialised(rows, frequent, bits), totals, cover)


def top(scored_phrases: DataFrame, limit: int = TOP) -> DataFrame:
    """Each language's first phrases: best within salted parts first, so that one large language is no single sort."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = scored_phrases.withColumn("__part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order)))
    last = first.filter(F.col("rank") <= limit).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return last.filter(F.col("rank") <= limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
