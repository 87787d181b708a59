"""Byte-level BPE encoding and decoding with a transducer lexicon of the corpus's frequent words.

First pass: every pre-token ("word") of every text is counted; each task adds its own first. A histogram of the
counts gives the smallest count with at most ``LEXICON`` words above it (the lexicon's bound, with ``LONGEST`` bytes a
word); these words and their ids are compiled into a minimal acyclic transducer (``transducer.py``), written once
to the shared folder and handed to the executors by Spark, whose tasks memory-map it.

Second pass: a task cuts texts into words, looks the distinct ones up in the automaton in step, and merges those
it does not hold by the tokenizer's merge list, exactly: always the leftmost pair of lowest rank. All words of one
length are merged at once; words above ``STEP_BYTES`` go through a heap instead. The lexicon saves work and changes no id.
Decoding puts the bytes of all ids together.

Words are cut as the tokenizer's pattern does. Its library and this one may know different Unicode versions;
code points they class differently are found when a vocabulary is read, and texts that hold one are cut by the library.
Strings of added tokens in a text give their ids, as in the library.

Null text: empty (no ids). Repeated rows are encoded each. Texts may be of any length. Rows without ``doc_id`` are kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common as C
from tidepool.llm import transducer

LEXICON = 1 << 16          # words of the lexicon at most
LONGEST = 48               # bytes of a lexicon word at most
STEP_BYTES = 64            # words up to this size are merged in step
COUNTED = 400_000          # distinct words a task counts before it sends them
CHUNK = 1 << 22            # bytes of text encoded at once
CACHED = 300_000           # distinct words a task keeps with their ids
LEVELS = 16                # steps of the count histogram in a doubling

# The pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(PATTERN)
# The same over Latin, Cyrillic and common punctuation, whose classes every Unicode version agrees on: twice as fast.
_LETTER, _NUMBER, _BLANK = "A-Za-zªµºÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_COMMON_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
                           f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_uncommon = re.compile("[^\x00-ɏЀ-ҁҊ-ԯ–—‘’“”…]").search
_NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Merges:
    """The merge list of a byte-level BPE file, and the ids that its bytes start from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.data = json.load(f)
        model = self.data["model"]
        self.ids = ids = model["vocab"]
        letters = byte_letters()
        self.size = 1 + max([*ids.values(), *(t["id"] for t in self.data["added_tokens"])])
        suffix = model.get("end_of_word_suffix") or ""
        self.byte_id = np.array([ids[c] for c in letters], np.int64)
        self.last_id = np.array([ids[c + suffix] for c in letters], np.int64)    # a word's last byte
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)         # by rank
        self.rank_of: dict[int, int] | None = None                               # filled for the first long word

        # ranks of all pairs of bytes, and of those whose second byte ends a word
        inner = self.byte_id[:, None]
        self.byte_rank = self.rank(inner, self.byte_id[None, :])
        self.last_rank = self.rank(inner, self.last_id[None, :])

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE).astype(np.int32)

    def merge_step(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids a word) of words given as rows of bytes, ``size`` of which count: one merge a word at a time."""
        n, length = words.shape
        ids, size, every = self.byte_id[words].astype(np.int32), size.astype(np.int64), np.arange(n)
        ids[every, size - 1] = self.last_id[words[every, size - 1]]
        if length > 1:
            place = np.arange(length)
            rank = self.byte_rank[words[:, :-1], words[:, 1:]]
            two = np.flatnonzero(size > 1)
            rank[two, size[two] - 2] = self.last_rank[words[two, size[two] - 2], words[two, size[two] - 1]]
            rank[place[:-1] >= size[:, None] - 1] = _NONE
            # words that still merge are kept together, so that each round works on these alone
            live, part, own, left = every, ids, rank, size.copy()
            while True:
                at = np.argmin(own, axis=1)                      # the leftmost of the lowest
                best = own[np.arange(len(live)), at]
                some = best < _NONE
                if not some.all():
                    done = live[~some]
                    ids[done], size[done] = part[~some], left[~some]
                    live, part, own, left, at, best = live[some], part[some], own[some], left[some], at[some], best[some]
                if not len(live):
                    break
                rows = np.arange(len(live))
                later = place[:-1] > at[:, None]
                part[:, :-1] = np.where(later, part[:, 1:], part[:, :-1])
                part[rows, at] = self.merged[best]
                left -= 1
                own[:, :-1] = np.where(later[:, :-1], own[:, 1:], own[:, :-1])
                own[:, -1] = _NONE
                after = self.rank(part[rows, at], part[rows, np.minimum(at + 1, length - 1)])
                own[rows, at] = np.where(at < left - 1, after, _NONE)
                inside = np.flatnonzero(at > 0)
                own[inside, at[inside] - 1] = self.rank(part[inside, at[inside] - 1], part[inside, at[inside]])
        return ids[place_mask(size, length)], size

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word by a heap of (rank, place): n log n, for words of any length."""
        if self.rank_of is None:
            self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        get, size, merged = self.rank_of.get, self.size, self.merged
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.last_id[word[-1]])
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue                                         # one of the two has been merged since
            ids[i], ids[j] = int(merged[r]), None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := get(ids[i] * size + ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (r := get(ids[before[i]] * size + ids[i])) is not None:
                heapq.heappush(heap, (r, before[i], ids[before[i]], ids[i]))
        return np.array([i for i in ids if i is not None], np.int64)


class Vocabulary(Merges):
    """What encoding and decoding need of a tokenizer file."""

    def __init__(self, path: str):
        super().__init__(path)
        model, cut, added = self.data["model"], self.data["pre_tokenizer"] or {}, self.data["added_tokens"]
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges") if model.get(k)]
        if cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space") or self.data["normalizer"] or odd:
            raise ValueError("not a plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be plain strings")
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        spelt = [b""] * self.size
        for token, i in self.ids.items():
            spelt[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in added}
        for token, i in self.special.items():
            spelt[i] = token.encode()
        self.at_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.spelt, self.spelt_n = np.frombuffer(b"".join(spelt), np.uint8), np.array([len(s) for s in spelt])
        self.spelt_at = np.cumsum(self.spelt_n) - self.spelt_n
        figures = [f"{i},".encode() for i in range(self.size)]
        self.figures, self.figures_n = np.frombuffer(b"".join(figures), np.uint8), np.array([len(s) for s in figures])
        self.figures_at = np.cumsum(self.figures_n) - self.figures_n

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids' tokens, what is no UTF-8 replaced."""
        raw = transducer.gather(self.spelt, self.spelt_at[ids], self.spelt_n[ids]).tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw

    def written(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return transducer.gather(self.figures, self.figures_at[ids], self.figures_n[ids])[:-1].tobytes()


WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64)     # words of near lengths share a table


def by_width(words: list[bytes], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, words as rows of bytes filled up with zeros, sizes) of the words of 1 to ``most`` bytes, by width."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    low = 0
    for width in (*(w for w in WIDTHS if w < most), most):
        rows = np.flatnonzero((sizes > low) & (sizes <= width))
        low = width
        if len(rows):
            table = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in rows.tolist()]), np.uint8).reshape(-1, width)
            yield rows, table, sizes[rows]


def place_mask(size: np.ndarray, length: int) -> np.ndarray:
    return np.arange(length) < size[:, None]


def classed_apart(path: str) -> str:
    """Code points that the library's pattern and this one's class differently, as the inside of a pattern's brackets."""
    import unicodedata

    from tokenizers import Tokenizer
    cut = Tokenizer.from_file(path).pre_tokenizer
    letter, number, blank = (regex.compile(p).match for p in (r"\p{L}", r"\p{N}", r"\s"))
    found = []
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        kind = "L" if letter(s) else "N" if number(s) else "Z" if blank(s) else "C"
        known = unicodedata.category(s)[0]
        # only where this interpreter's Unicode data and the pattern's disagree can the library's disagree as well
        if (kind in "LN" or known in "LN") and kind != known or kind == "Z" and known not in "ZC":
            text = f"a{s}b 1{s}2!{s}? {s}"
            if [t for t, _ in cut.pre_tokenize_str(text)] != [_spelt(w) for w in _WORDS.findall(text)]:
                found.append(c)
    parts, i = [], 0
    while i < len(found):
        j = i
        while j + 1 < len(found) and found[j + 1] == found[j] + 1:
            j += 1
        parts.append(f"\\U{found[i]:08x}-\\U{found[j]:08x}")
        i = j + 1
    return "".join(parts)


_LETTERS = byte_letters()


def _spelt(word: str) -> str:
    return "".join(_LETTERS[b] for b in word.encode())


class Cutter:
    """Words of a text as the library cuts it."""

    def __init__(self, path: str, vocabulary: Vocabulary, apart: str):
        self.path, self.vocabulary = path, vocabulary
        self.apart = re.compile(f"[{apart}]").search if apart else None
        self.library = None

    def plain(self, text: str) -> list[str]:
        if text.isascii() or not _uncommon(text):
            return _COMMON_WORDS.findall(text)
        if self.apart and self.apart(text):
            if self.library is None:
                from tokenizers import Tokenizer
                self.library = Tokenizer.from_file(self.path).pre_tokenizer
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return _WORDS.findall(text)

    def words(self, text: str) -> list[str | int]:
        """Words, and the ids of added tokens between them."""
        split = self.vocabulary.at_special
        if split is None or not split.search(text):
            return self.plain(text)
        out: list[str | int] = []
        for i, part in enumerate(split.split(text)):
            out += [self.vocabulary.special[part]] if i % 2 else self.plain(part)
        return out


class Encoder:
    """Ids of texts; a bounded number of distinct words is kept with theirs."""

    def __init__(self, path: str, vocabulary: Vocabulary, lexicon: transducer.Transducer | None, apart: str):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.cutter = Cutter(path, vocabulary, apart)
        self.looked_up = self.merged = 0
        self.clear()

    def clear(self) -> None:
        special = sorted(self.vocabulary.special.values())
        self.place: dict[str | int, int] = {i: k for k, i in enumerate(special)}
        self.pool = [np.array(special, np.int64)]
        self.sizes = [np.ones(len(special), np.int64)]
        self._flat()

    def _flat(self) -> None:
        self.pool, self.sizes = [np.concatenate(self.pool)], [np.concatenate(self.sizes)]
        self.size = self.sizes[0]
        self.at = np.cumsum(self.size) - self.size

    def learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        for rows, table, size in by_width(raw, STEP_BYTES):
            if self.lexicon is not None:
                found, ids, n = self.lexicon.lookup(table, size)
                self._keep([words[i] for i in rows[found].tolist()], ids, n)
                self.looked_up += len(n)
                rows, table, size = rows[~found], table[~found], size[~found]
            if len(rows):
                self._keep([words[i] for i in rows.tolist()], *self.vocabulary.merge_step(table, size))
                self.merged += len(rows)
        for i in [i for i, w in enumerate(raw) if len(w) > STEP_BYTES]:
            self._keep([words[i]], ids := self.vocabulary.merge_long(raw[i]), np.array([len(ids)]))
        self._flat()

    def _keep(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.place)
        self.place.update(zip(words, range(n, n + len(words)), strict=True))
        self.pool.append(ids.astype(np.int64))
        self.sizes.append(size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids a text)."""
        cut = [self.cutter.words(t) for t in texts]
        flat = [w for words in cut for w in words]
        new = set(flat).difference(self.place)
        if len(self.place) + len(new) > CACHED:
            self.clear()
            new = set(flat).difference(self.place)
        if new:
            self.learn(list(new))
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        bounds = np.cumsum([0] + [len(words) for words in cut])
        return transducer.gather(self.pool[0], self.at[at], self.size[at]), C.sums(self.size[at], bounds)


_read: dict[tuple, object] = {}


def vocabulary(path: str) -> Vocabulary:
    if ("vocabulary", path) not in _read:
        _read["vocabulary", path] = Vocabulary(path)
    return _read["vocabulary", path]


# ------------------------------------------------------------------ lexicon

def _word_counts(path: str, apart: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, counts = Cutter(path, vocabulary(path), apart), Counter()

        def sent():
            kept = [(w, n) for w, n in counts.items() if isinstance(w, str) and len(w.encode()) <= LONGEST]
            counts.clear()
            for lo in range(0, len(kept), 1 << 16):
                part = kept[lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], names=["word", "n"])
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                for t in texts:
                    counts.update(cutter.words(t.decode("utf-8", "replace")))
                if len(counts) >= COUNTED:
                    yield from sent()
        yield from sent()
    return run


def frequent_words(docs: DataFrame, path: str, apart: str, limit: int = LEXICON) -> DataFrame:
    """The most frequent words of all texts: as many steps of the count histogram as hold ``limit`` words."""
    counts = C.settle(docs.select("text").mapInArrow(_word_counts(path, apart), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n") * LEVELS)
    total, least = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        total += r["words"]
        if total > limit:
            break
        least = r["level"]
    return counts.filter(level >= least) if least is not None else counts.limit(0)


def build_lexicon(docs: DataFrame, path: str, limit: int = LEXICON) -> str:
    """Compiles the frequent words and hands the file to Spark's executors; returns its name there."""
    spark, known = docs.sparkSession, vocabulary(path)
    apart = classed_apart(path)
    words = C.settle(frequent_words(docs, path, apart, limit).select("word"))
    held = words.toArrow().column("word").to_pylist()
    encoder = Encoder(path, known, None, "")
    encoder.learn(held)
    pairs = []
    for w in held:
        k = encoder.place[w]
        pairs.append((w.encode(), tuple(encoder.pool[0][encoder.at[k]:encoder.at[k] + encoder.size[k]].tolist())))
    data = transducer.to_bytes(transducer.compile_words(sorted(pairs)), {"apart": apart})
    # Spark writes the raw bytes as one line of text, on whatever file system the shared folder is
    folder = C.shared_folder(spark)
    spark.createDataFrame([(bytearray(data),)], "data binary").select(F.col("data").cast("string")).coalesce(1).write.text(folder)
    file = spark.read.text(folder).inputFiles()[0]
    spark.sparkContext.addFile(file)
    return file.rsplit("/", 1)[1]


# ------------------------------------------------------------------ tasks

def _encoded(path: str, lexicon: str, result: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = transducer.Transducer.open(SparkFiles.get(lexicon))
        known = vocabulary(path)
        encoder = Encoder(path, known, mapped, mapped.extra["apart"])
        for batch in batches:
            for lo, hi, texts in C.chunks(batch, limit=CHUNK):
                ids, size = encoder.encode([t.decode("utf-8", "replace") for t in texts])
                end = np.cumsum(size)
                yield result(known, batch.column("doc_id").slice(lo, hi - lo), [ids[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)])
    return run


def _ids(known: Vocabulary, doc_id: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_id, pa.array([len(i) for i in ids], pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())],
                                      names=["doc_id", "n_tokens", "ids"])


def _digests(known: Vocabulary, doc_id: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array([len(i) for i in ids], pa.int64()), pa.array([hashlib.sha256(known.written(i)).hexdigest() for i in ids]),
         pa.array([hashlib.sha256(known.decode(i)).hexdigest() for i in ids])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, limit: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every document."""
    rows = C.doc_texts(docs)
    return rows.mapInArrow(_encoded(path, build_lexicon(rows, path, limit), _ids), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of the ids that ``encode`` gave."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            texts = [known.decode(np.frombuffer(b, "<u4")).decode() for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, limit: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, sha256 of the ids as text, and of the text decoded from them."""
    rows = C.doc_texts(docs)
    return rows.mapInArrow(_encoded(path, build_lexicon(rows, path, limit), _digests),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
