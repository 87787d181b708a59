"""Token ids in binary shards with a minimal perfect hash index over document keys.

Documents are range-partitioned and sorted by doc_id, each partition tokenises its whole texts, appends the
end id and writes shards of at most about ``SHARD_IDS`` ids (a longer document has a shard of its own). A shard is one file:

    header    8 bytes magic, then little-endian 64-bit numbers: documents, ids, bytes per id, end id, hash seed
    payload   the raw ids of all documents, back to back, in ascending doc_id order (repeated keys in input order)
    keys      int64 doc_id of each document, then int64 start of each (ids before it in the shard)
    index     minimal perfect hash of the distinct keys: uint32 displacement of each bucket, then for each slot
              a uint32 fingerprint of its key and a uint32 number of the key's first document

The hash is hash-and-displace: keys fall into buckets of about four; buckets are placed largest first, each with
the least displacement that sends its keys to free slots (a bucket of one key holds its slot itself). Lookup of a key reads one displacement and one slot; the
stored fingerprint rejects (all but 2**-32 of) foreign keys, and the key stored with the document settles the rest.

Files are written under a temporary name and renamed, so a retried task replaces its file with the same
content. They go through pyarrow's file systems to the shared folder and are read back by Spark's ``binaryFile`` source.

Defined cases: a null or empty text is the end id alone. Rows with a null doc_id come first and have no key: they
are in the payload with the reserved key -2**63 and not in the index. Repeated doc_ids stand next to each other, ordered by
text hash; the index gives the first. An empty table writes no shard. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import common as C
from tidepool.llm import tokens as K

MAGIC = b"TIDSHARD"
END_ID = 2
SHARD_IDS = 4_000_000
BUCKET = 4
NO_KEY = -(1 << 63)
MAX_KEYS = 100_000         # of one lookup
DIRECT = np.uint32(1 << 31)
SLOT = np.dtype([("print", "<u4"), ("doc", "<u4")])


def hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    return C.mix(np.asarray(keys, np.int64).view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))


def _slot(h: np.ndarray, shift, n: int) -> np.ndarray:
    """Slot of hashed keys under displacement(s) ``shift``."""
    return (C.mix(h ^ (np.asarray(shift, np.uint64) * np.uint64(0xD6E8FEB86659FD93))) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements, slots) of a minimal perfect hash of distinct keys; slots hold positions in ``keys``."""
    n = len(keys)
    for seed in range(1, 65):
        h = hashed(keys, seed)
        m = max(1, -(-n // BUCKET))
        bucket = (h % np.uint64(m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(m + 1))
        shifts, taken, owner = np.zeros(m, np.uint32), np.zeros(n, bool), np.zeros(n, np.int64)
        for b in np.argsort(-np.diff(cut), kind="stable").tolist():
            members = order[cut[b]:cut[b + 1]]
            if not len(members):
                break
            if len(members) == 1:                      # the rest are single keys: any free slots do
                rest = [c for c in range(m) if cut[c + 1] - cut[c] == 1]
                free = np.flatnonzero(~taken)
                shifts[rest] = free.astype(np.uint32) | DIRECT
                owner[free] = order[cut[rest]]
                return _finish(keys, seed, shifts, owner)
            own = h[members]
            lo, found = 0, -1
            while found < 0 and lo < 1 << 22:          # displacements are tried in growing batches
                step = np.arange(lo, lo + 16 + lo, dtype=np.uint64)
                at = _slot(own[None, :], step[:, None], n)
                good = ~taken[at].any(axis=1)
                s = np.sort(at, axis=1)
                good &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if good.any():
                    found = int(np.argmax(good))
                    slots = at[found]
                    shifts[b] = lo + found
                lo += len(step)
            if found < 0:
                break
            taken[slots], owner[slots] = True, members
        if taken.all():
            return _finish(keys, seed, shifts, owner)
    raise ValueError("no perfect hash found; keys repeat")


def _finish(keys, seed, shifts, owner):
    slots = np.empty(len(keys), SLOT)
    slots["print"], slots["doc"] = C.mix(hashed(keys, seed)[owner]) >> np.uint64(32), owner
    return seed, shifts, slots


class Shard:
    """Constant-time keyed access to the ids of a shard's documents."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token shard")
        docs, ids, width, self.end_id, self.seed = np.frombuffer(content, "<i8", 5, 8).tolist()
        at = 48
        self.ids = np.frombuffer(content, f"<u{width}", ids, at)
        at += ids * width
        self.keys, self.starts = np.frombuffer(content, "<i8", docs, at), np.frombuffer(content, "<i8", docs, at + 8 * docs)
        at += 16 * docs
        distinct, m = np.frombuffer(content, "<i8", 2, at).tolist()
        self.shifts = np.frombuffer(content, "<u4", m, at + 16)
        self.slots = np.frombuffer(content, SLOT, distinct, at + 16 + 4 * m)

    def document(self, i: int) -> np.ndarray:
        end = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.ids)
        return self.ids[self.starts[i]:end]

    def find(self, key: int) -> int | None:
        """Number of the first document with this key."""
        if not len(self.slots):
            return None
        h = hashed(np.array([key]), self.seed)
        shift = self.shifts[int(h[0] % np.uint64(len(self.shifts)))]
        slot = self.slots[int(shift ^ DIRECT) if shift & DIRECT else _slot(h, shift, len(self.slots))[0]]
        if slot["print"] != C.mix(h)[0] >> np.uint64(32) or self.keys[slot["doc"]] != key:
            return None
        return int(slot["doc"])

    def get(self, key: int) -> np.ndarray | None:
        i = self.find(key)
        return None if i is None else self.document(i)


def shard_bytes(keys: list[int], ids: list[np.ndarray], dtype: np.dtype) -> bytes:
    docs = np.array(keys, "<i8")
    lengths = np.array([len(x) for x in ids], np.int64)
    known, first = np.unique(docs, return_index=True)
    first = first[known != NO_KEY]
    if len(first):
        seed, shifts, slots = build_index(docs[first])
        slots["doc"] = first[slots["doc"]]
    else:
        seed, shifts, slots = 1, np.zeros(0, np.uint32), np.zeros(0, SLOT)
    head = np.array([len(docs), lengths.sum(), dtype.itemsize, END_ID, seed], "<i8")
    return b"".join([MAGIC, head.tobytes(), *[x.astype(dtype).tobytes() for x in ids], docs.tobytes(),
                     (np.cumsum(lengths) - lengths).astype("<i8").tobytes(),
                     np.array([len(slots), len(shifts)], "<i8").tobytes(), shifts.astype("<u4").tobytes(), slots.tobytes()])


def _write(path: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = K.encoder(path, spaced=True)
        store, base = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        keys, ids, size, made = [], [], 0, []

        def flush() -> None:
            nonlocal keys, ids, size
            name = f"{base}/part-{task.partitionId():06d}-{len(made):05d}.ids"
            temporary = f"{base}/.{task.taskAttemptId()}-{len(made)}"
            with store.open_output_stream(temporary) as out:
                out.write(shard_bytes(keys, ids, enc.dtype))
            store.move(temporary, name)
            made.append((task.partitionId(), len(made), len(keys), size))
            keys, ids, size = [], [], 0

        for batch in batches:
            for lo, hi, texts in C.chunks(batch, limit=K.CHUNK):
                names = batch.column(0).slice(lo, hi - lo).fill_null(NO_KEY).to_pylist()
                for key, x in zip(names, enc.encode([t.decode("utf-8") for t in texts]), strict=True):
                    if size and size + len(x) >= SHARD_IDS:
                        flush()
                    keys.append(key)
                    ids.append(np.append(x, enc.dtype.type(END_ID)))
                    size += len(x) + 1
        if keys:
            flush()
        enc.clear()
        cols = list(zip(*made, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                          pa.array(cols[3], pa.int64())], names=["part", "shard", "n_docs", "n_ids"])
    return run


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Write the shards to ``folder`` (a new one, shared by all) and return (part, shard, n_docs, n_ids)."""
    folder = C.qualified(docs.sparkSession, folder)
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    rows = C.doc_texts(docs)
    mark = F.xxhash64("text")
    width = max(8, C.shuffle_width(docs.sparkSession))
    return C.settle(rows.repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id", mark)
                    .mapInArrow(C.frugal(_write(path, folder)), "part int, shard int, n_docs long, n_ids long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, content in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "content")), strict=True):
            shard = Shard(content)
            crc = [zlib.crc32(shard.document(i).astype("<u4").tobytes()) for i in range(len(shard.keys))]
            n = np.diff(np.append(shard.starts, len(shard.ids)))
            docs = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(docs, part), pa.int32()), pa.array(np.full(docs, number), pa.int32()),
                 pa.array([None if k == NO_KEY else k for k in shard.keys.tolist()], pa.int64()),
                 pa.array(shard.starts), pa.array(n.astype(np.int64)), pa.array(crc, pa.int64())],
                names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])


def files(spark, folder: str) -> DataFrame:
    """(part, shard, content) of every shard."""
    name = F.regexp_extract(F.col("path"), r"part-(\d+)-(\d+)\.ids$", 1), F.regexp_extract(F.col("path"), r"part-(\d+)-(\d+)\.ids$", 2)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder)
            .select(name[0].cast("int").alias("part"), name[1].cast("int").alias("shard"), "content"))


def digest(spark, folder: str, shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it in the whole store), n_tokens, ids_crc32."""
    # one row a shard: first the parts' sums (one window over them), then shards within a part
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("p"))
    inner = F.sum("n_ids").over(W.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    base = shards.withColumn("q", inner).join(before, "part").select("part", "shard", (F.col("p") + F.col("q")).alias("base"))
    rows = files(spark, folder).mapInArrow(C.frugal(_read), "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(base, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark, folder: str, keys: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents with the given keys (at most ``MAX_KEYS``), through each shard's index."""
    if len(keys) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} keys at once")
    wanted = np.unique(np.array(keys, np.int64))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content").to_pylist():
                shard = Shard(content)
                lo, hi = np.searchsorted(wanted, [shard.keys[0], shard.keys[-1] + 1])
                found = [(k, x.tolist()) for k in wanted[lo:hi].tolist() if (x := shard.get(k)) is not None]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return files(spark, folder).mapInArrow(C.frugal(fetch), "doc_id long, ids array<long>")
