"""Best-fit packing of tokenised documents, certified by dual feasible functions.

Each document becomes the ids of its whole text and an end id. Only documents longer than a sequence are cut,
into full pieces and a last shorter one. Full pieces are a sequence each. The others are dealt at random to
groups of about ``GROUP`` pieces, and each group is packed by best-fit decreasing in one task (only lengths
and numbers travel). For every group a lower bound of its bins is taken from dual feasible functions over its
lengths; a group that meets its bound is certified optimal and closed. The unfilled sequences of the others
are exchanged: they are dealt, whole, to new and fewer groups, repacked by best-fit decreasing, and the new
packing replaces the old one where it needs fewer sequences. Rounds end when nothing is open, when the
bound of the whole table is met, or after ``ROUNDS``.

Defined cases: a null or empty text is the end id alone. Every row is packed, repeated rows and null ids as
well. An empty table gives no rows. Extra columns are ignored. Groups are bounded and numbered by a hash, so one
source or document with many pieces spreads over them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common as C
from tidepool.llm import tokens as K

CAPACITY, END_ID = 2048, 0
GROUP, ROUNDS = 50_000, 3
CACHE_UNITS = 300_000     # workers keep their cache while other stages of a pipeline run
CHUNK = 1 << 21           # bytes of text encoded at once: half of what other encoders take
ROW = "seq long, length int, sequence_id long, offset int, fill int, certified boolean"


def bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of bins that any packing needs: the best of two families of dual feasible functions."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    # threshold functions: sizes under e count nothing, sizes over capacity - e a whole bin
    total, many = np.concatenate([[0], np.cumsum(count * x)]), np.concatenate([[0], np.cumsum(count)])
    e = np.arange(1, capacity // 2 + 1)
    kept = total[capacity - e + 1] - total[e] + capacity * (many[-1] - many[capacity - e + 1])
    best = max(best, int((-(-kept // capacity)).max()))
    # rounding functions: size to the fraction below with denominator k, unless it is one of k + 1
    for k in range(1, 33):
        whole = (k + 1) * x % capacity == 0
        scaled = np.where(whole, k * x, (k + 1) * x // capacity * capacity)      # times k * capacity
        best = max(best, -(-int((count * scaled).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece by best-fit decreasing; bins with equal room are kept in stacks."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = made = 0                                   # bit r: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, at, made = capacity, made, made + 1
        bins[i], offsets[i] = at, capacity - room
        left = room - size
        if left:
            stacks[left].append(at)
            rooms |= 1 << left
    return bins, offsets


def _pack(p: pd.DataFrame) -> pd.DataFrame:
    """Pack one group; a group that came in sequences (fill > 0) keeps them unless fewer will do."""
    lengths, seq = p["length"].to_numpy(), p["seq"].to_numpy()
    bins, offsets = best_fit(lengths)
    made, least = int(bins.max()) + 1, bound(lengths)
    if "sequence_id" in p and p["sequence_id"].nunique() <= made:
        return p.assign(certified=p["sequence_id"].nunique() == least)[[c.split()[0] for c in ROW.split(", ")]]
    name = np.zeros(made, np.int64)
    name[bins[offsets == 0]] = seq[offsets == 0]       # a sequence is called after its first piece
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    return pd.DataFrame({"seq": seq, "length": lengths, "sequence_id": name[bins], "offset": offsets,
                         "fill": fill[bins], "certified": made == least})


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = K.encoder(path, spaced=False, cache_units=CACHE_UNITS)
        for batch in batches:
            for lo, hi, texts in C.chunks(batch, limit=CHUNK):
                rows = []
                for k, ids in enumerate(enc.encode([t.decode("utf-8") for t in texts])):
                    ids = np.append(ids, END_ID).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), CAPACITY)):
                        part = ids[start:start + CAPACITY]
                        rows.append((lo + k, n, start, len(part), zlib.crc32(part.tobytes())))
                at, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
        enc.clear()
    return run


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    return C.doc_texts(docs).mapInArrow(C.frugal(_pieces(path)), "doc_id long, piece int, start long, length long, ids_crc32 long")


def table_bound(lengths: DataFrame) -> int:
    """The lower bound for all pieces at once, from a histogram of at most ``CAPACITY`` rows."""
    rows = lengths.groupBy("length").agg(F.count("*").alias("n")).collect()
    full = sum(r["n"] for r in rows if r["length"] == CAPACITY)
    return full + bound(np.repeat([r["length"] for r in rows if r["length"] < CAPACITY] or [0],
                                  [r["n"] for r in rows if r["length"] < CAPACITY] or [0]).astype(np.int64))


def assign(numbered: DataFrame) -> DataFrame:
    """(seq, sequence_id, offset) for pieces shorter than a sequence, given as (seq, length)."""
    def dealt(rows: DataFrame, by: str, turn: int) -> tuple[DataFrame, int]:
        n = max(1, -(-rows.count() // GROUP))
        return rows.withColumn("group", F.pmod(F.xxhash64(by, F.lit(turn)), F.lit(n))), n

    def sequences(rows: DataFrame) -> int:
        return rows.filter("offset = 0").count()

    least = table_bound(numbered)
    rows, n = dealt(numbered, "seq", 0)
    state = C.settle(rows.groupBy("group").applyInPandas(_pack, ROW))
    closed, done, made = [], 0, sequences(state)
    for turn in range(1, ROUNDS + 1):
        if done + made <= least:
            break                                      # nothing can be packed into fewer
        unfilled = "not certified and fill < %d" % CAPACITY
        full = state.filter(f"not ({unfilled})")
        closed.append(full)
        kept = sequences(full)
        rows, n = dealt(state.filter(unfilled), "sequence_id", turn)
        state = C.settle(rows.groupBy("group").applyInPandas(_pack, ROW))
        before, done, made = made, done + kept, sequences(state)
        if n == 1 and kept + made == before:
            break                                      # one group, dealt alike, packs alike again
    out = state
    for c in closed:
        out = out.union(c)
    return out.select("seq", "sequence_id", "offset")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    all_pieces = C.settle(pieces(docs, path).withColumn("seq", F.monotonically_increasing_id()))
    full = all_pieces.filter(F.col("length") == CAPACITY).withColumns({"sequence_id": F.col("seq"), "offset": F.lit(0)})
    short = all_pieces.filter(F.col("length") < CAPACITY)
    placed = assign(short.select("seq", F.col("length").cast("int").alias("length")))
    return full.unionByName(short.join(placed, "seq")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset"))
