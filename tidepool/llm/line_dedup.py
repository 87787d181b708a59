"""Fuzzy line dedup by MinHash: one line of each component of near-equal lines stays in the corpus.

A line is what stands between line feeds, trimmed of ASCII white space. Lines of at least ``MIN_CHARS`` code
points take part; shorter ones are always kept, as too little to tell a copy from coincidence. Equal trimmed
lines are one class. Classes whose sets of ``SHINGLE``-code-point shingles have a Jaccard similarity of at
least ``SIMILARITY`` are linked; of all occurrences in a component of links the first one (smallest doc_id,
then place) is kept and the others are removed.

Method: one hash of each shingle fills a one-permutation MinHash signature (empty bins borrow from their right
neighbour); ``BANDS`` bands of ``ROWS`` values give keys, on which two lines of similarity ``SIMILARITY`` meet
with probability 1 - (1 - 0.8**5)**14 = 0.996, and at 0.9 of 0.99999. Keys travel as packed arrays, after
dropping repeats inside a task. In each run of classes with one key, every class is first verified against the
run's least class (exact Jaccard on whole lines), which settles all pairs with that class. Runs whose other classes
still span several components after a distributed union-find are then compared in full inside tasks, large runs in
blocks, skipping members that are already connected and pairs that sizes and parity maps rule out: no pair that
shares a key is left unverified unless it is already in one component or cannot be alike.

Defined cases: a null text has no lines and stays null; rows with the same doc_id and text get the same
decision (they are one document); equal lines inside one document are copies as well. A document that loses its last
line gets the empty text. An empty table gives no rows. Other columns are carried unread.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import common as C

SHINGLE, MIN_CHARS, SIMILARITY = 8, 16, 0.8
ROWS, BANDS = 5, 14
BINS = ROWS * BANDS
BLANK = b" \t\n\r\x0b\x0c"
FLUSH = 1 << 18            # band keys a task packs at once
REMEMBER = 200_000         # line hashes a task remembers to skip repeats (a speed matter only)
AT_ONCE = 1 << 17          # text whose shingles are hashed at once; small, as it stays in the processor's cache
RUN_BLOCK = 512            # rows of a run compared in one block
PAIR = np.dtype([("key", "<u8"), ("line", "<u8")])


def trimmed_lines(text: bytes) -> list[tuple[int, bytes, int]]:
    """(number, trimmed line, signed 64-bit hash) of the lines that take part."""
    out = []
    for i, line in enumerate(text.split(b"\n")):
        line = line.strip(BLANK)
        if len(line) >= MIN_CHARS and (len(line) >= 4 * MIN_CHARS or len(line.decode("utf-8", "replace")) >= MIN_CHARS):
            h = xxhash.xxh3_64_intdigest(line)
            out.append((i, line, h - (1 << 64) if h >> 63 else h))
    return out


def spans(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive items that start within one ``limit`` of the running size."""
    cut = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit)) + 1
    edge = [0, *cut.tolist(), len(sizes)]
    return (x for x in itertools.pairwise(edge) if x[0] < x[1])


def windows(lines: list[bytes]) -> list[np.ndarray]:
    """Hashes of each line's shingles in turn, repeats included; many lines are hashed at once."""
    out = []
    for lo, hi in spans(np.fromiter(map(len, lines), np.int64, len(lines)), AT_ONCE):
        points = np.frombuffer(b"\n".join(lines[lo:hi]).decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        end = np.append(np.flatnonzero(points == 10), len(points))
        start = np.concatenate([[0], end[:-1] + 1])
        grams = C.Rolling(points).windows(SHINGLE)
        out += [grams[a:b] for a, b in zip(start.tolist(), (end - SHINGLE + 1).tolist(), strict=True)]  # none spans a line feed
    return out


def ordered(parts: list[np.ndarray], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts as one array, sorted between ``bounds``, and which values differ from those before them there."""
    h = np.concatenate(parts)
    for lo, hi in itertools.pairwise(bounds.tolist()):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[bounds[:-1]] = True
    return h, new


def band_keys(lines: list[bytes]) -> np.ndarray:
    """Lines x BANDS keys of the MinHash signatures."""
    parts = windows(lines)
    h = np.concatenate(parts)
    where = ((h >> np.uint64(40)) * np.uint64(BINS) >> np.uint64(24)).view(np.int64)
    where += np.repeat(np.arange(len(lines)) * BINS, [len(x) for x in parts])
    empty = np.uint32(0xFFFFFFFF)
    sig = np.full(len(lines) * BINS, empty, np.uint32)
    np.minimum.at(sig, where, h.astype(np.uint32) >> np.uint32(1))
    sig = sig.reshape(-1, BINS)
    twice = np.concatenate([sig, sig], axis=1) != empty
    source = np.where(twice, np.arange(2 * BINS), 4 * BINS)
    source = np.minimum.accumulate(source[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    full = np.take_along_axis(sig, source % BINS, axis=1).astype(np.uint64)
    full += (source - np.arange(BINS)).astype(np.uint64) << np.uint64(32)   # how far it was borrowed
    return np.stack([C.chain([full[:, b * ROWS + r] for r in range(ROWS)]) + np.uint64(b) for b in range(BANDS)], axis=1)


PARITY = 256               # bits of a line's parity map
MAPS = [f"map{i}" for i in range(PARITY // 64)]


def parities(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each line, and for each of ``PARITY`` cells whether an odd number of them falls into it.

    Two lines' maps differ in at most as many cells as the lines differ in shingles, so unlike lines are told
    from their maps without their texts.
    """
    parts = windows(lines)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    h, new = ordered(parts, np.concatenate([[0], np.cumsum(sizes)]))
    h, owner = h[new], np.repeat(np.arange(len(lines)), sizes)[new]
    odd = np.bincount(owner * PARITY + (h >> np.uint64(56)).astype(np.int64), minlength=len(lines) * PARITY) & 1
    return np.bincount(owner, minlength=len(lines)), np.packbits(odd.astype(bool).reshape(len(lines), PARITY), axis=1, bitorder="little").view("<u8")


def shingles(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a trimmed line."""
    return C.distinct(C.Rolling(np.frombuffer(text.encode("utf-32-le"), "<u4")).windows(SHINGLE))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    h = np.concatenate([a, b])
    h.sort(kind="stable")                              # merges the two sorted sets
    both = np.count_nonzero(h[1:] == h[:-1])
    return 5 * both >= 4 * (len(a) + len(b) - both)


# ------------------------------------------------------------------ tasks

def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, texts in C.chunks(batch):
            rows = [(lo + k, i, h) for k, t in enumerate(texts) for i, _, h in trimmed_lines(t)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["doc_id", "mark", "number", "line"])


def _fresh(texts: list[bytes], seen: set[int]) -> dict[int, bytes]:
    """Lines of the texts by hash, without those this task has met (it remembers a bounded number)."""
    if len(seen) > REMEMBER:
        seen.clear()
    found = {h: line for t in texts for _, line, h in trimmed_lines(t) if h not in seen}
    seen.update(found)
    return found


def _packed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                lines = _fresh(texts, seen)
                if not lines:
                    continue
                pairs = np.empty(len(lines) * BANDS, PAIR)
                pairs["key"] = band_keys(list(lines.values())).ravel()
                pairs["line"] = np.repeat(np.fromiter(lines, np.int64, len(lines)).view(np.uint64), BANDS)
                held.append(pairs)
                size += len(pairs)
                if size >= FLUSH:
                    yield C.packed(np.concatenate(held), width, "key")
                    held, size = [], 0
        if held:
            yield C.packed(np.concatenate(held), width, "key")
    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, line, least) of the keys that two or more classes have; a partition holds whole keys."""
    pairs = C.shared(batches, PAIR, "key")
    run = C.run_of(pairs["key"])
    least = pairs["line"][np.searchsorted(run, run)]
    yield from C.columns({"key": pairs["key"], "line": pairs["line"], "least": least})


def _wanted_texts(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = wanted.value, set()
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                lines = _fresh(texts, seen)
                names = np.fromiter(lines, np.int64, len(lines))
                hit = C.in_bitmap(found, names.view(np.uint64))
                kept = [x for x, h in zip(lines.values(), hit, strict=True) if h]
                if not kept:
                    continue
                size, maps = parities(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[hit]), pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()), pa.array(size.astype(np.int32)),
                     *[pa.array(np.ascontiguousarray(maps[:, i]).view(np.int64)) for i in range(len(MAPS))]],
                    names=["line", "content", "size", *MAPS])
    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose lines are alike: one sort of both lines' shingles gives the size of their union."""
    for b in batches:
        alike_here = [np.zeros(0, bool)]
        texts, others = b.column("content").cast(pa.binary()), b.column("least_content").cast(pa.binary())
        both = (b.column("size").to_numpy().astype(np.int64) + b.column("least_size").to_numpy())
        least = b.column("least").to_numpy()
        for lo, hi in spans(pc.add(pc.binary_length(texts), pc.binary_length(others)).to_numpy().astype(np.int64), C.CHUNK_BYTES):
            run = C.run_of(least[lo:hi])               # neighbours with the same other line hash it once
            first = np.searchsorted(run, np.arange(run[-1] + 1)) + lo
            mine, its = windows(texts.slice(lo, hi - lo).to_pylist()), windows(others.take(pa.array(first)).to_pylist())
            sizes = np.fromiter((len(x) + len(its[r]) for x, r in zip(mine, run, strict=True)), np.int64, hi - lo)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            _, new = ordered([y for x, r in zip(mine, run, strict=True) for y in (x, its[r])], bounds)
            union = np.add.reduceat(new, bounds[:-1], dtype=np.int64)
            alike_here.append(5 * (both[lo:hi] - union) >= 4 * union)
        yield b.filter(pa.array(np.concatenate(alike_here))).select(["line", "least"])


def _undecided(component: np.ndarray, size: np.ndarray, maps: np.ndarray, block: np.ndarray | None) -> list[tuple[int, int]]:
    """Pairs of a cell's rows in different components (and blocks) whose sizes and maps allow them to be alike."""
    i, j = np.tril_indices(len(component), -1)
    apart = component[i] != component[j]
    if block is not None:
        apart &= block[i] != block[j]
    i, j = i[apart], j[apart]
    both = size[i] + size[j]
    near = 9 * np.abs(size[i] - size[j]) <= both
    i, j, both = i[near], j[near], both[near]
    near = 9 * np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1, dtype=np.int64) <= both
    return list(zip(i[near].tolist(), j[near].tolist(), strict=True))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each cell (key, lo, hi) between members of different components, all pairs that need it."""
    for (_, lo, hi), rows in C.groups(batches, 3):
        lines, block, component, content, size, *maps = zip(*(r[3:] for r in rows), strict=True)
        parent = {c: c for c in component}

        def find(c: int) -> int:
            while parent[c] != c:
                c = parent[c]
            return c

        pairs = _undecided(np.array(component), np.array(size), np.array(maps).view(np.uint64).T, None if lo == hi else np.array(block))
        some = sorted({k for pair in pairs for k in pair})
        sets = dict(zip(some, map(C.distinct, windows([content[k].encode() for k in some])), strict=True))
        links = []
        for i, j in pairs:
            if (a := find(component[i])) != (b := find(component[j])) and alike(sets[i], sets[j]):
                parent[a] = b
                links.append((lines[i], lines[j]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                                         names=["line", "least"])


# ------------------------------------------------------------------ operator

def line_components(docs: DataFrame) -> DataFrame:
    """(node, component) of the classes of lines that are linked to another class."""
    spark = docs.sparkSession
    texts = C.doc_texts(docs)
    width = max(8, C.shuffle_width(spark))
    keys = C.settle(texts.select("text").mapInArrow(_packed(width), "bucket int, pairs binary")
                    .repartition(width, "bucket").mapInArrow(_shared_keys, "key long, line long, least long"))
    wanted = spark.sparkContext.broadcast(C.bitmap(keys, "line"))
    described = C.settle(texts.select("text").mapInArrow(_wanted_texts(wanted), "line long, content string, size int, " + ", ".join(f"{m} long" for m in MAPS))
                         .groupBy("line").agg(F.min("content").alias("content"), *[F.first(c).alias(c) for c in ("size", *MAPS)]))
    content, facts = described.select("line", "content"), described.drop("content")
    pairs = keys.filter("line <> least").select("line", "least").distinct()
    # lines are alike if 9 times the shingles they differ in is at most the shingles of both; the maps differ in no more
    other = facts.select(F.col("line").alias("least"), *[F.col(c).alias(f"least_{c}") for c in ("size", *MAPS)])
    differ = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"least_{m}"))) for m in MAPS), F.lit(0))
    both = F.col("size") + F.col("least_size")
    pairs = (pairs.join(facts, "line").join(other, "least")
             .filter((9 * differ <= both) & (9 * F.abs(F.col("size") - F.col("least_size")) <= both)).select("line", "least", "size", "least_size"))
    least = content.select(F.col("line").alias("least"), F.col("content").alias("least_content"))
    links = C.settle(pairs.join(content, "line").join(least, "least").select("line", "least", "size", "least_size", "content", "least_content")
                     .mapInArrow(_verified, "line long, least long"))
    known = C.settle(C.components(links, "line", "least"))
    placed = keys.filter("line <> least").select("key", "line").join(known.withColumnRenamed("node", "line"), "line", "left").select(
        "key", "line", F.coalesce("component", "line").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("key")
    rest = placed.join(open_keys, "key", "left_semi")
    more = (C.block_pairs(rest, "key", "line", RUN_BLOCK).join(described, "line")
            .select("key", "lo", "hi", "line", "block", "component", "content", "size", *MAPS)
            .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "line")
            .mapInArrow(_compared, "line long, least long"))
    return C.components(links.union(more), "line", "least")


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, removed): the numbers (from 0) of each document's lines that go."""
    rows = C.doc_texts(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    lines = C.settle(rows.mapInArrow(_occurrences, "doc_id long, mark long, number int, line long"))
    place = F.struct("doc_id", "mark", "number")
    classes = lines.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    linked = C.settle(line_components(docs))
    named = C.settle(classes.join(linked.withColumnRenamed("node", "line"), "line", "left")
                     .filter("component is not null or not (first <=> last)"))
    alone = named.filter("component is null and not (first <=> last)").select("line", "first")
    grouped = named.filter("component is not null")
    firsts = grouped.groupBy("component").agg(F.min("first").alias("kept"))
    copies = alone.union(grouped.join(firsts, "component").select("line", F.col("kept").alias("first")))
    gone = lines.join(copies, "line").filter(~place.eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("number")).alias("removed"))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, removed: pd.Series) -> pd.Series:
    def cut(t, gone):
        if t is None:
            return None
        gone = set(gone)
        return "\n".join([x for i, x in enumerate(t.split("\n")) if i not in gone])
    return pd.Series([cut(t, g) for t, g in zip(text, removed, strict=True)], dtype=object)


def rewrite(docs: DataFrame) -> DataFrame:
    """``docs`` with texts rewritten, and ``__removed``, the count of lines taken out."""
    gone = removals(docs).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("removed").alias("__gone"))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64(text).alias("own"), text.alias("text"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("__id")) & (F.col("own") == F.col("__mark")), "left")
    cut = _without(F.when(F.col("__gone").isNotNull(), F.col("text")), F.col("__gone"))
    return joined.select(F.col("row").withField("text", F.coalesce(cut, F.col("text"))).alias("row"),
                         F.coalesce(F.size("__gone"), F.lit(0)).alias("__removed")).select("row.*", "__removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; documents that lost their last line are gone, others have their kept lines."""
    out = rewrite(docs)
    return out.filter((F.col("__removed") == 0) | (F.trim(F.translate("text", "\n\r\t", "   ")) != "")).drop("__removed")
