"""Shared helpers: settled intermediate tables, hashed words of whole texts, connected components."""

from __future__ import annotations

import ctypes
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

CHUNK_BYTES = 1 << 19  # text handled at once inside a task (a longer text is one chunk of its own)
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
LANES = 32             # 8-byte steps of a hash in numpy; longer ranges are hashed one by one
RUN_FOLDER = "spark.tidepool.run.folder"
ROUNDS = 64            # far above what pointer jumping needs; reaching it raises


def shared_folder(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir`` (below the warehouse where that is unset, as in tests).

    A caller that sets ``RUN_FOLDER`` to a folder of the shared store gets all of a run's tables there, and may drop it once
    the run's results are written.
    """
    base = spark.conf.get(RUN_FOLDER, None) or checkpoint_dir(spark, spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the file system that Spark finds it on (its default one, if none is named)."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/_where")
    return spark.read.parquet(f"{folder}/_where").inputFiles()[0].rsplit("/_where/", 1)[0]


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Whole texts and packed values are long rows: fewer of them in an Arrow batch keep tasks and their Python workers small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def doc_texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever other columns a caller's table has."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


# ------------------------------------------------------------------ memory of Python workers

def release() -> None:
    """Gives free memory back to the system: Spark keeps a worker for later tasks, and idle ones would hold what the last one used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                                 # another C library than glibc


def frugal(run):
    """A task's function that releases memory when its rows have been taken."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped


# ------------------------------------------------------------------ hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C13            # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**n`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have


#: ASCII white space that separates words: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def byte_hashes(padded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; ``padded`` has 8 bytes more than any range reaches.

    Eight bytes at a time go through a bijective finaliser, so regular texts spread like any other (a polynomial
    modulo 2**64 gives equal hashes to unlike Thue-Morse words). Ranges above ``LANES`` words go to xxhash.
    """
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (max(len(padded) - 7, 0),), (1,), writeable=False)
    size = end - start
    out = mix(size.astype(np.uint64) * _M2 + _M1)
    short = size <= 8 * LANES
    left = np.flatnonzero(short & (size > 0))
    for k in range(LANES):
        if not len(left):
            break
        lane = lanes[start[left] + 8 * k]
        rest = np.minimum(size[left] - 8 * k, 8).astype(np.uint64)
        lane = lane & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest))
        out[left] = mix((out[left] ^ lane) * _M2 + np.uint64(0x632BE59BD9B4E019))
        left = left[size[left] > 8 * (k + 1)]
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh3_64_intdigest(padded[start[i]:end[i]])
    return out


class Rolling:
    """64-bit hashes of the short windows of a sequence of small numbers, equal wherever they stand.

    For windows of a few values only: over a thousand values and more, regular sequences would meet.
    """

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        weighted = (values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, self.size)[:self.size]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted)])

    def windows(self, k: int) -> np.ndarray:
        """Hash of the ``k`` values from each place on."""
        n = max(0, self.size - k + 1)
        return mix((self.prefix[k:k + n] - self.prefix[:n]) * powers(_INVERSE, self.size)[:n])


class Block:
    """Words of several texts at once: byte ranges, owners and 64-bit hashes, as flat arrays."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n = len(texts)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, self.n)
        self.doc_start = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer((b"\n".join(texts) + b"\n" if texts else b"") + bytes(8), np.uint8)
        self.padded = LOWER[raw] if lower else raw
        self.bytes = raw = self.padded[:-8]
        space = SPACE[raw]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, self.doc_start)   # words before each text
        self.n_words = np.diff(self.first)
        self.owner = np.repeat(np.arange(self.n), self.n_words)
        self.words = byte_hashes(self.padded, self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of k words inside one text."""
        at = np.arange(max(0, len(self.words) - k + 1))
        at = at[self.owner[at] == self.owner[at + k - 1]]
        return at, chain([self.words[at + i] for i in range(k)])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; records are sorted by their fields in turn."""
    keep = np.ones(len(values), bool)
    if values.dtype.names:
        values = values[np.lexsort([values[n] for n in reversed(values.dtype.names)])]
        keep[1:] = np.logical_or.reduce([values[n][1:] != values[n][:-1] for n in values.dtype.names])
    else:
        values = np.sort(values)
        keep[1:] = values[1:] != values[:-1]
    return values[keep]


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several hashes, order kept."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + p + np.uint64(0x632BE59BD9B4E019))
    return out


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from row, to row, whole texts as UTF-8) of slices of about ``limit`` bytes; a null text is empty."""
    texts = batch.column(column).cast(pa.large_binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    lo = size = 0
    for i, n in enumerate([*sizes, limit]):
        if size and (i == len(sizes) or size + n > limit):
            yield lo, i, [t or b"" for t in texts.slice(lo, i - lo).to_pylist()]
            lo, size = i, 0
        size += n + 1


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


# ------------------------------------------------------------------ groups

def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of consecutive rows with equal first ``keys`` columns, across batch ends; one group is held."""
    stream = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, rows in itertools.groupby(stream, key=lambda r: r[:keys]):
        yield key, list(rows)


def block_pairs(rows: DataFrame, key: str, member: str, limit: int) -> DataFrame:
    """Deal groups so that every two members of a group meet in one cell of about ``2 * limit`` rows at most.

    A group of up to ``limit`` rows is one cell. A larger one is split by the member's hash into blocks, and a
    row goes to the cells of its block with every block. Adds ``lo``, ``hi`` (the cell) and ``block``.
    """
    sizes = rows.groupBy(F.col(key).alias("__key")).agg(F.ceil(F.count("*") / limit).cast("int").alias("__blocks"))
    dealt = rows.join(sizes, F.col(key) == F.col("__key")).withColumn(
        "block", F.pmod(F.xxhash64(member), F.col("__blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    return (dealt.withColumn("__other", other)
            .withColumns({"lo": F.least("block", "__other"), "hi": F.greatest("block", "__other")})
            .drop("__key", "__blocks", "__other"))


def unpack(values: np.ndarray, width: int) -> np.ndarray:
    """Bucket below ``width`` of each 64-bit hash, rising with the hash."""
    return (values >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)


def packed(pairs: np.ndarray, width: int, key: str) -> pa.RecordBatch:
    """Distinct records, sorted, as one binary value for each bucket of their ``key``."""
    pairs = distinct(pairs)
    cut = np.searchsorted(unpack(pairs[key], width), np.arange(width + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cut))
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([pairs[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary())],
        names=["bucket", "pairs"])


def shared(batches: Iterator[pa.RecordBatch], kind: np.dtype, key: str) -> np.ndarray:
    """The records of a partition's packed values whose ``key`` stands in two or more of them, sorted."""
    held = [np.frombuffer(p, kind) for b in batches for p in b.column("pairs").to_pylist()]
    if not held:
        return np.zeros(0, kind)
    pairs = distinct(np.concatenate(held))
    return pairs[np.bincount(run := run_of(pairs[key]))[run] > 1]


def run_of(keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal neighbours that each of the sorted keys is in."""
    return np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]])) - 1 if len(keys) else np.zeros(0, np.int64)


def columns(arrays: dict[str, np.ndarray], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Batches of 64-bit columns."""
    n = len(next(iter(arrays.values())))
    for lo in range(0, n, rows):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a[lo:lo + rows]).view(np.int64)) for a in arrays.values()],
                                         names=list(arrays))


def bitmap(hashes: DataFrame, column: str, bits: int = 27) -> np.ndarray:
    """A bitmap of the low ``bits`` bits of every hash, as bytes: a filter of fixed size, whatever the input's.

    Built by Spark in pieces of 4 KB; only the pieces (2**bits bits in all) reach the driver.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    pieces = hashes.groupBy(F.shiftright(place, 15).alias("k")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("m")).collect()
    out = np.zeros(max(4096, (1 << bits) // 8), np.uint8)
    for row in pieces:
        out[row["k"] * 4096:(row["k"] + 1) * 4096] = np.frombuffer(row["m"], np.uint8)
    return out


def in_bitmap(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap (never misses one that is)."""
    place = hashes & np.uint64(len(found) * 8 - 1)
    return (found[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


# ------------------------------------------------------------------ components

def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each batch's links (same connectivity, at most one link a node)."""
    for b in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p] if p in parent else p
            return x

        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        pairs = [(x, r) for x in list(parent) if (r := find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                          pa.array([p[1] for p in pairs], pa.int64())], names=["node", "root"])


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Distributed union-find: (node, component) of every linked node, component = smallest node reachable.

    Links are first thinned to a spanning forest inside each Arrow batch. Each round then hooks every
    node's root to the smallest root seen across a link (partial ``min`` before the shuffle, so a hub of
    many links is collapsed map-side), and jumps pointers; rounds end when no link crosses two roots.
    Nodes without links to another node are not returned; null ends and self links are ignored.
    """
    spark = links.sparkSession
    pairs = links.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b")).dropna()
    schema = "node long, root long"
    tree = settle(pairs.mapInArrow(_shrink, schema))
    for _ in range(ROUNDS):
        # large star: each node's neighbours that are larger hang below its least neighbour
        both = tree.select(F.col("node").alias("x"), F.col("root").alias("y")).union(
            tree.select(F.col("root").alias("x"), F.col("node").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        hung = (both.filter("y > x").join(least, "x").select(F.col("y").alias("node"), F.col("m").alias("root"))
                .mapInArrow(_shrink, schema))
        # small star: each node and its smaller neighbours hang below the least of them
        low = hung.groupBy("node").agg(F.min("root").alias("m"))
        new = settle(hung.join(low, "node").select(
            F.explode(F.array_distinct(F.array("node", "root"))).alias("node"), F.col("m").alias("root"))
            .filter("node > root").distinct())
        done = new.groupBy("node").count().filter("count > 1").limit(1)
        roots = new.join(new.select(F.col("node").alias("root")).distinct(), "root", "left_semi").limit(1)
        if not done.union(roots.selectExpr("node", "1L")).take(1):
            out = new.select("node", F.col("root").alias("component"))
            top = new.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
            return out.union(top)
        tree = new
    raise RuntimeError("links did not settle")

