"""Substring dedup: words under a 50-word window that also starts in a document with a smaller doc_id are removed.

Words are runs without ASCII white space, compared unchanged; windows are judged on the input. Each shard holds a
compressed FM-index (``fm_index``) of word sequences, and documents are streamed through it by backward
search, which gives the matches of at least ``WINDOW`` words that a smaller document has.

Which shard must index and stream which words is settled by content. Every window has one anchor, the 8-word
gram with the least hash in it (a minimizer), so equal windows have equal anchors. Consecutive windows of one
anchor form a stretch of about 70 words. Anchors that two or more different documents have are found first, from
packed (anchor, document) records; only stretches of such anchors travel, to the shard their anchor hashes
to. So a shard gets every stretch that could share a window with another one there, and work follows the text that
repeats, not the square of documents. An anchor with more than ``HOT`` stretches is spread: its documents
fall into blocks, and each pair of blocks is a cell with its own shard. Documents with equal words are one
class, known by its smallest doc_id; of equal stretches in a shard one is indexed (with the smallest id), and one is
streamed for all but the smallest.

Words are 64-bit hashes (40 bits of them travel), which is what a false match would need to repeat over 50 words.
Fixed sizes: bitmaps of 16 MB, which only say what may be left out, and the list of hot anchors (at most
``HOT_ANCHORS``).

Defined cases: null, empty and blank texts have no words; the kept text is then empty. Rows with one doc_id are one
document, whose texts take nothing from each other. Rows with a null doc_id neither lose nor cause anything.
Repeated rows get equal results. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common as C
from tidepool.llm import fm_index

WINDOW, GRAM = 50, 8
SPAN = WINDOW - GRAM + 1
SHARD_WORDS = 600_000
HOT, HOT_ANCHORS = 4096, 1 << 16
FLUSH = 1 << 18
PAIR = np.dtype([("key", "<u8"), ("cls", "<u8")])
NOTHING = hashlib.sha256(b"").hexdigest()


class Stretches:
    """Runs of windows with one anchor, in several texts: owner, first word, words, anchor hash."""

    def __init__(self, block: C.Block):
        self.block = block
        n = len(block.words)
        windows = np.arange(max(0, n - WINDOW + 1))
        windows = windows[block.owner[windows] == block.owner[windows + WINDOW - 1]] if len(windows) else windows
        if not len(windows):
            self.owner = self.first = self.size = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        at, h = block.shingles(GRAM)
        grams[at] = h
        # hash above, place below: the least key of a window is its leftmost gram with the least hash
        low = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(n, dtype=np.uint64) & np.uint64(0xFFFFFF)
        reach = 1
        while reach * 2 <= SPAN:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        rest = SPAN - reach
        low = np.minimum(low[:len(low) - rest], low[rest:])
        anchor = windows + ((low[windows] & np.uint64(0xFFFFFF)).astype(np.int64) - windows & 0xFFFFFF)
        start = np.ones(len(windows), bool)
        start[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
        begin = np.flatnonzero(start)
        last = np.append(begin[1:], len(windows)) - 1
        self.first = windows[begin]
        self.size = windows[last] - self.first + WINDOW
        self.owner = block.owner[self.first]
        self.anchor = grams[anchor[begin]]


def classes_of(block: C.Block) -> np.ndarray:
    """64-bit name of each text's word sequence."""
    words = np.append(block.words, np.uint64(0)).view(np.uint8)
    return C.byte_hashes(words, block.first[:-1] * 8, block.first[1:] * 8)


# ------------------------------------------------------------------ tasks

def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in C.chunks(batch):
            block = C.Block(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(classes_of(block).view(np.int64)), pa.array(block.n_words, pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts])], names=["doc_id", "mark", "cls", "n_words", "whole"])


def _anchors(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                block = C.Block(texts)
                found = Stretches(block)
                pairs = np.empty(len(found.anchor), PAIR)
                pairs["key"], pairs["cls"] = C.mix(found.anchor), classes_of(block)[found.owner]
                held.append(C.distinct(pairs))
                size += len(held[-1])
                if size >= FLUSH:
                    yield C.packed(np.concatenate(held), width, "key")
                    held, size = [], 0
        if size:
            yield C.packed(np.concatenate(held), width, "key")
    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = C.shared(batches, PAIR, "key")
    yield from C.columns({"key": pairs["key"], "cls": pairs["cls"]})


class Deal:
    """Shards of an anchor's stretches: one, or those of every cell of its document's block if the anchor is hot."""

    def __init__(self, shards: int, hot: dict[int, int]):
        self.shards, self.hot = shards, hot

    def of(self, key: int, cls: int) -> list[int]:
        n = self.hot.get(key)
        if n is None:
            return [key % self.shards]
        b = (cls >> 7) % n
        return sorted({hash((key, min(b, j), max(b, j))) % self.shards for j in range(n)})


def _names(deal):
    """(shard, kind 0, cls, first, start, words): who has a stretch in which shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = deal.value
        for b in batches:
            rows = {(s, cls, first) for key, cls, first in zip(*(b.column(c).to_pylist() for c in ("key", "cls", "first")), strict=True) for s in d.of(key, cls)}
            yield _rows([(s, 0, cls, first, 0, b"") for s, cls, first in rows])
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["shard", "kind", "cls", "first", "start", "words"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _stretches(deal, wanted):
    """(shard, kind 1, cls, first, start, words): stretches whose anchor others may have, once a class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, found, seen = deal.value, wanted.value, set()
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                block = C.Block(texts)
                x = Stretches(block)
                key = C.mix(x.anchor)
                cls = classes_of(block).view(np.int64).tolist()
                new = np.array([c not in seen and not seen.add(c) for c in cls], bool)
                short = np.ascontiguousarray(block.words.view(np.uint8).reshape(-1, 8)[:, 3:])
                out = []
                for i in np.flatnonzero(C.in_bitmap(found, key) & new[x.owner]).tolist():
                    o, a = x.owner[i], x.first[i]
                    words = short[a:a + x.size[i]].tobytes()
                    out += [(s, 1, cls[o], None, int(a - block.first[o]), words) for s in d.of(int(key[i].view(np.int64)), cls[o])]
                if out:
                    yield _rows(out)
            if len(seen) > 2_000_000:
                seen.clear()                            # a speed matter: repeats are merged in the shards
    return run


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, from, to): words covered by windows of smaller documents, shard by shard."""
    for _, rows in C.groups(batches, 1):
        first = {r[2]: r[3] for r in rows if r[1] == 0}
        places: dict[bytes, set] = defaultdict(set)
        for _, kind, cls, _, start, words in rows:
            if kind and cls in first:
                places[words].add((first[cls], cls, start))
        if len(first) < 2 or not places:
            continue
        order = {f: i for i, f in enumerate(sorted(set(first.values())))}
        contents = list(places)
        raw = np.zeros((sum(map(len, contents)) // 5, 8), np.uint8)
        raw[:, 3:] = np.frombuffer(b"".join(contents), np.uint8).reshape(-1, 5)
        known, symbol = np.unique(raw.view(np.uint64).ravel(), return_inverse=True)
        cut = np.cumsum([0] + [len(c) // 5 for c in contents])
        sequences = [symbol[a:b].astype(np.int64) + 1 for a, b in zip(cut[:-1], cut[1:], strict=True)]
        owners = [sorted(places[c]) for c in contents]
        depth = 1 << int(max(map(len, sequences)) - 1).bit_length()
        index = fm_index.FMIndex(sequences, np.array([order[o[0][0]] for o in owners], np.int32), len(known), depth)
        # each distinct stretch is streamed for its smallest document, and once for all further ones
        jobs = [(i, [m for m in o if m[0] == o[0][0]]) for i, o in enumerate(owners)]
        jobs += [(i, rest) for i, o in enumerate(owners) if (rest := [m for m in o if m[0] > o[0][0]])]
        q, a, b = fm_index.covered(index, [sequences[i] for i, _ in jobs], np.array([order[m[0][0]] for _, m in jobs]), WINDOW)
        out = [(cls, start + x, start + y) for k, x, y in zip(q.tolist(), a.tolist(), b.tolist(), strict=True) for _, cls, start in jobs[k][1]]
        for lo in range(0, len(out), 50_000):
            part = out[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], pa.int64()) for i in range(3)], names=["cls", "from", "to"])


def _some(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield batch.filter(pa.array(C.in_bitmap(wanted.value, ids)))
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc_id, mark, text, spans in zip(*(b.column(c).to_pylist() for c in ("doc_id", "mark", "text", "spans")), strict=True):
            words = text.encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                gone[s["from"]] += 1
                gone[s["to"]] -= 1
            kept = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
            out.append((doc_id, mark, len(words) - len(kept), b" ".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
             pa.array([o[3].decode() for o in out], pa.string())], names=["doc_id", "mark", "n_removed", "kept"])


# ------------------------------------------------------------------ operator

def spans(docs: DataFrame, info: DataFrame) -> DataFrame:
    """(cls, from, to): covered words of every class, told for its smallest document."""
    spark = docs.sparkSession
    texts = C.doc_texts(docs).filter("doc_id is not null")
    width = max(8, C.shuffle_width(spark))
    keys = C.settle(texts.select("text").mapInArrow(_anchors(width), "bucket int, pairs binary")
                    .repartition(width, "bucket").mapInArrow(_shared_keys, "key long, cls long"))
    n = keys.count()
    limit = max(HOT, n // HOT_ANCHORS)
    many = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > limit).collect()       # at most HOT_ANCHORS rows
    shards = max(1, -(-n * 75 // SHARD_WORDS))
    deal = spark.sparkContext.broadcast(Deal(shards, {r["key"]: -(-r["n"] // limit) for r in many}))
    wanted = spark.sparkContext.broadcast(C.bitmap(keys, "key"))
    first = info.filter("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first"))
    row = "shard int, kind int, cls long, first long, start long, words binary"
    both = keys.join(first, "cls").mapInArrow(_names(deal), row).unionByName(texts.select("text").mapInArrow(_stretches(deal, wanted), row))
    return (both.repartition(max(1, min(shards, 4 * width)), "shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(_searched, "cls long, from long, to long"))


def remove(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words (``kept``)."""
    texts = C.doc_texts(docs).withColumn("mark", F.xxhash64("text"))
    info = C.settle(texts.select("doc_id", "mark", "text").mapInArrow(
        _described, "doc_id long, mark long, cls long, n_words long, whole string"))
    found = C.settle(spans(docs, info))
    first = info.filter("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first"))
    known = C.settle(info.join(first, "cls", "left").withColumn(
        "copy", F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW), F.lit(False))))
    # a span list is bounded by its document's words
    lists = found.groupBy("cls").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    cut = C.settle(known.filter("not copy and doc_id is not null").select("doc_id", "mark", "cls").distinct().join(lists, "cls").drop("cls"))
    wanted = docs.sparkSession.sparkContext.broadcast(C.bitmap(cut, "doc_id"))
    changed = (texts.filter("doc_id is not null").select("doc_id", "mark", "text").mapInArrow(_some(wanted), "doc_id long, mark long, text string")
               .join(cut, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).mapInArrow(_cut, "doc_id long, mark long, n_removed long, kept string"))
    fixed = changed.withColumn("sha", F.sha2(F.col("kept").cast("binary"), 256)).select(
        F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.col("n_removed").alias("r"), "sha", *(["kept"] if with_text else []))
    out = known.join(fixed, (F.col("doc_id") == F.col("d")) & (F.col("mark") == F.col("m")), "left").select(
        "doc_id", "mark", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("r", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(NOTHING)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
        *([F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []))
    return out.drop("mark")
