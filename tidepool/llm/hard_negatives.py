"""Hard negatives by rotated one-bit codes whose intervals hold the true inner product.

A vector's scaled integer form ``v`` is rotated at random; the signs of the rotated components are its code ``x`` (a
unit vector of one bit a component). Stored with it are the alignment ``a = <v, x>`` and the length of ``v``. For an
anchor ``q`` the code gives ``t = <x, q>`` by popcounts over the bit planes of the rotated, quantised anchor, with an
error of at most the quantisation's length. Since ``v = a x + r`` with ``r`` orthogonal to ``x``, Cauchy-Schwarz gives

    <v, q>  in  a t  +-  |r| sqrt(|q|^2 - t^2)

without any chance of failure. Pairs whose interval cannot reach the anchor's weakest kept row (or a positive's band
of scores) are dropped; all others are scored in integers. So every result is exact, whatever the intervals drop.

The anchors are a stated query set. They are taken in waves of ``WAVE`` numbers at most (the broadcast's bound), dealt by
hash; each wave meets all rows in blocks, twice: once for its positives, once for the negatives of these. A task
returns at most ``k`` rows an anchor (and positive), whichever label or id is frequent, and one shuffle ranks them.

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Vectors meet those with as
many components only; empty vectors score 0. Rows repeated in full count once; where unlike rows share an id,
each is a row (and anchor) of its own, but none meets a row with its own id, and equal scores of one id count once.
Scores are exact at any size of components; one beyond 64 bits raises. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import common as C

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95           # per cent of the positive's score between which a negative lies
WAVE = 1 << 23               # numbers of the anchors that are broadcast at once (64 MB as doubles)
PLANES = 6                   # bits of a quantised anchor's component
BLOCK = 1024                 # rows, and anchors, compared at once
DENSE = 16                   # a block with more than one survivor in so many pairs is scored as a whole
SEED = 7
EXACT = 1 << 53

CODED = "id long, label long, anchor boolean, dim int, numbers binary, code binary, along double, norm double"


# ------------------------------------------------------------------ codes

_rotations: dict[int, np.ndarray] = {}


def width_of(dim: int) -> int:
    return max(64, -(-dim // 64) * 64)


def rotate(v: np.ndarray) -> np.ndarray:
    """Rows, padded to whole 64-bit words, turned by one random rotation."""
    width = width_of(v.shape[1])
    if width not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(width, width)))
        _rotations[width] = q * np.sign(np.diag(r))
    return v @ _rotations[width][:v.shape[1]]


def narrow(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of three types that holds them."""
    top = np.abs(v).max(initial=0)
    return v.astype("<i2") if top < 1 << 15 else v.astype("<i4") if top < 1 << 31 else v.astype("<f8")


def widened(data: list[bytes], dim: int) -> np.ndarray:
    """Stored numbers as doubles (exact: they are whole and came from doubles)."""
    if not dim:
        return np.zeros((len(data), 0))
    kinds = {2 * dim: "<i2", 4 * dim: "<i4", 8 * dim: "<f8"}
    if len({len(d) for d in data}) == 1:
        return np.frombuffer(b"".join(data), kinds[len(data[0])]).reshape(-1, dim).astype(float)
    return np.stack([np.frombuffer(d, kinds[len(d)]).astype(float) for d in data])


def code(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code words, alignment, length) of the rows."""
    turned = rotate(v)
    words = np.packbits(turned >= 0, axis=1, bitorder="little").view("<u8")
    return words, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]), np.sqrt((v * v).sum(axis=1))


@dataclass
class Anchors:
    """Anchors with equally many components: their numbers, and the bit planes of their rotated form."""

    index: np.ndarray
    id: np.ndarray
    label: np.ndarray
    numbers: np.ndarray
    planes: np.ndarray = field(init=False)       # plane x word x anchor

    def __post_init__(self):
        turned = rotate(self.numbers)
        self.width = turned.shape[1]
        self.norm = np.sqrt((self.numbers * self.numbers).sum(axis=1))
        self.least = turned.min(axis=1)
        self.step = (turned.max(axis=1) - self.least) / ((1 << PLANES) - 1)
        units = np.rint((turned - self.least[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]).astype(np.int64)
        self.error = np.sqrt(np.square(turned - self.least[:, None] - units * self.step[:, None]).sum(axis=1))
        self.total = units.sum(axis=1)
        bits = [np.packbits((units >> j & 1).astype(bool), axis=1, bitorder="little").view("<u8").T for j in range(PLANES)]
        self.planes = np.ascontiguousarray(np.stack(bits))

    def take(self, at: np.ndarray) -> Anchors:
        out = object.__new__(Anchors)
        for name, v in vars(self).items():
            setattr(out, name, v if name == "width" else v[:, :, at] if name == "planes" else v[at])
        return out

    def intervals(self, words: np.ndarray, along: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible inner product of every row (down) with every anchor (across)."""
        inside = np.zeros((len(words), len(self.id)), np.int32)
        for j in range(PLANES):
            for w in range(words.shape[1]):
                inside += np.bitwise_count(words[:, w, None] & self.planes[j, w]).astype(np.int32) << j
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        t = (self.least * (2 * ones[:, None] - self.width) + self.step * (2 * inside - self.total)) / np.sqrt(self.width)
        rest = np.sqrt(np.maximum(norm ** 2 - along ** 2, 0))[:, None]
        away = np.sqrt(np.maximum(self.norm ** 2 - np.maximum(np.abs(t) - self.error, 0) ** 2, 0))
        half = along[:, None] * self.error + rest * away + 1e-9 * norm[:, None] * self.norm + 1e-6
        middle = along[:, None] * t
        return middle - half, middle + half


def dot(rows: np.ndarray, anchors: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact integer products of pairs (row number, anchor number)."""
    bound = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(rows.shape[1], 1)
    if not len(at):
        return np.zeros(0, np.int64)
    if bound < EXACT:
        if len(at) * DENSE > len(rows) * len(anchors):
            return (rows @ anchors.T)[at, to].astype(np.int64)
        return np.concatenate([np.einsum("ij,ij->i", rows[at[i:i + 65536]], anchors[to[i:i + 65536]]) for i in range(0, len(at), 65536)]).astype(np.int64)
    left, right = {i: [int(x) for x in rows[i]] for i in set(at.tolist())}, {i: [int(x) for x in anchors[i]] for i in set(to.tolist())}
    return np.array([sum(x * y for x, y in zip(left[i], right[j], strict=True)) for i, j in zip(at.tolist(), to.tolist(), strict=True)], object).astype(np.int64)


# ------------------------------------------------------------------ tasks

def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scaled whole numbers and code of each row that takes part."""
    for batch in batches:
        vectors = batch.column("v").to_pylist()
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            if None not in v:
                by_size.setdefault(len(v), []).append(i)
        for dim, rows in by_size.items():
            v = np.floor(SCALE * np.array([vectors[i] for i in rows], float).reshape(len(rows), dim))
            fine = np.isfinite(v).all(axis=1)
            v, rows = v[fine], [i for i, ok in zip(rows, fine.tolist(), strict=True) if ok]
            words, along, norm = code(v)
            kept = batch.select(["id", "label", "anchor"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([dim] * len(rows), pa.int32()), pa.array([r.tobytes() for r in narrow(v)], pa.binary()),
                 pa.array([w.tobytes() for w in words], pa.binary()), pa.array(along), pa.array(norm)],
                names=["id", "label", "anchor", "dim", "numbers", "code", "along", "norm"])


@dataclass
class Block:
    id: np.ndarray
    label: np.ndarray
    numbers: np.ndarray
    words: np.ndarray
    along: np.ndarray
    norm: np.ndarray


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """Coded rows by number of components, rows repeated in full once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK).to_pydict()
            by_size: dict[int, dict] = {}
            for i, key in enumerate(zip(part["dim"], part["id"], part["label"], part["numbers"], strict=True)):
                by_size.setdefault(key[0], {}).setdefault(key, i)
            for dim, rows in by_size.items():
                at = list(rows.values())
                words = np.frombuffer(b"".join(part["code"][i] for i in at), "<u8").reshape(len(at), -1)
                yield dim, Block(np.array([part["id"][i] for i in at]), np.array([part["label"][i] for i in at]),
                                 widened([part["numbers"][i] for i in at], dim), words,
                                 np.array([part["along"][i] for i in at]), np.array([part["norm"][i] for i in at]))


class Best:
    """The first ``k`` rows of each slot so far, by score and id; equal (slot, id, score) count once."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.weakest = np.full(slots, np.iinfo(np.int64).min, np.int64)   # a slot's k-th score, once it has k rows

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort([ids, ~score, slot])                            # ~ turns the order of all longs
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        slot, score, ids = slot[new], score[new], ids[new]
        begin = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - begin
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        last = rank == self.k - 1
        self.weakest[slot[last]] = score[last]

    def batches(self) -> Iterator[pa.RecordBatch]:
        yield from C.columns({"slot": self.slot, "score": self.score, "id": self.id})


def _positives(anchors: dict[int, Anchors], slots: int, k: int):
    """Each anchor's first rows of its own label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(slots, k)
        for dim, rows in blocks(batches):
            if dim not in anchors:
                continue
            every = anchors[dim]
            for label in np.intersect1d(rows.label, every.label):
                at = np.flatnonzero(rows.label == label)
                same = np.flatnonzero(every.label == label)
                for lo in range(0, len(same), BLOCK):
                    some = every.take(same[lo:lo + BLOCK])
                    low, high = some.intervals(rows.words[at], rows.along[at], rows.norm[at])
                    other = rows.id[at][:, None] != some.id
                    reach = best.weakest[some.index].astype(float)
                    if len(at) >= k and len(np.unique(rows.id[at])) == len(at):      # k rows of the block surely score so much
                        sure = np.partition(np.where(other, low, -np.inf), len(at) - k, axis=0)[len(at) - k]
                        reach = np.maximum(reach, sure)
                    i, j = np.nonzero((high >= _below(reach)) & other)
                    best.add(some.index[j], dot(rows.numbers[at], some.numbers, i, j), rows.id[at][i])
        yield from best.batches()
    return run


def _below(x: np.ndarray) -> np.ndarray:
    """A double that no long turned to a double passes: longs above 2**53 may have been rounded up."""
    return x - np.abs(x) * 2.0 ** -52


def _negatives(anchors: dict[int, Anchors], slots: int, bands: tuple[np.ndarray, np.ndarray], per: int, k: int):
    """For each anchor's positive (``per`` slots an anchor) the first rows of other labels inside its band."""
    least, most = bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(slots * per, k)
        for dim, rows in blocks(batches):
            if dim not in anchors:
                continue
            every = anchors[dim]
            for lo in range(0, len(every.id), BLOCK):
                some = every.take(np.arange(lo, min(lo + BLOCK, len(every.id))))
                low, high = some.intervals(rows.words, rows.along, rows.norm)
                slot = some.index * per + np.arange(per)[:, None]
                from_, to = np.maximum(least[slot], best.weakest[slot]), most[slot]
                open_ = from_ <= to
                hit = np.zeros(low.shape, bool)
                for f, t, some_left in zip(from_, to, open_, strict=True):
                    if some_left.any():
                        hit |= (high >= _below(f.astype(float))) & (low <= t.astype(float) + np.abs(t) * 2.0 ** -52) & some_left
                hit &= (rows.label[:, None] != some.label) & (rows.id[:, None] != some.id)
                i, j = np.nonzero(hit)
                score = dot(rows.numbers, some.numbers, i, j)
                for s, f, t in zip(slot, from_, to, strict=True):
                    inside = (score >= f[j]) & (score <= t[j])
                    best.add(s[j[inside]], score[inside], rows.id[i[inside]])
        yield from best.batches()
    return run


# ------------------------------------------------------------------ plan

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "slot long, score long, id long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    first = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc("id"))
    return found.repartition("slot").distinct().withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _waves(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with their wave; no wave has more than ``WAVE`` numbers, by count (a single anchor may)."""
    cells, count, widest = anchors.agg(F.sum(F.greatest("dim", F.lit(1))), F.count("*"), F.max("dim")).first()
    waves = -(-(cells or 0) // WAVE)
    while waves > 1:
        dealt = anchors.withColumn("wave", F.pmod(F.xxhash64("id", "label", "numbers"), F.lit(waves)))
        most = dealt.groupBy("wave").agg(F.sum(F.greatest("dim", F.lit(1))).alias("n")).agg(F.max("n")).first()[0]
        if most <= max(WAVE, widest) or waves > 8 * count:
            return dealt, waves
        waves = waves * 5 // 4 + 1
    return anchors.withColumn("wave", F.lit(0)), waves


def _wave(spark, coded: DataFrame, wave: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Results of one wave's anchors."""
    rows = wave.select("id", "label", "dim", "numbers").toArrow().to_pydict()
    slots = len(rows["id"])
    anchors = {}
    for dim in set(rows["dim"]):
        at = [i for i, d in enumerate(rows["dim"]) if d == dim]
        anchors[dim] = Anchors(np.array(at), np.array([rows["id"][i] for i in at]), np.array([rows["label"][i] for i in at]),
                               widened([rows["numbers"][i] for i in at], dim))
    found = _ranked(coded.mapInArrow(_positives(anchors, slots, positives), FOUND), positives).toArrow().to_pydict()
    least, most = np.ones(slots * positives, np.int64), np.zeros(slots * positives, np.int64)    # no band
    pairs = []
    for slot, rank, score, other in zip(found["slot"], found["rank"], found["score"], found["id"], strict=True):
        at = slot * positives + rank - 1
        least[at], most[at] = -(-low * score // 100), high * score // 100
        pairs.append((at, rows["id"][slot], other, score))
    table = pa.table({"slot": pa.array([p[0] for p in pairs], pa.int64()), "anchor_id": pa.array([p[1] for p in pairs], pa.int64()),
                      "positive_id": pa.array([p[2] for p in pairs], pa.int64()), "positive_score": pa.array([p[3] for p in pairs], pa.int64())})
    hard = _ranked(coded.mapInArrow(_negatives(anchors, slots, (least, most), positives, negatives), FOUND), negatives)
    return hard.join(spark.createDataFrame(table), "slot").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of each anchor's positives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative has another label than the anchor and ``low`` to ``high`` per cent of the positive's score.
    """
    spark = rows.sparkSession
    C.small_batches(spark)
    chosen = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor")).dropna(subset=["id", "label", "v"])
    coded = C.settle(chosen.mapInArrow(_coded, CODED))
    anchors = C.settle(coded.filter("anchor").select("id", "label", "dim", "numbers").distinct())
    dealt, waves = _waves(anchors)
    coded = coded.drop("anchor")
    if waves == 1:
        return _wave(spark, coded, dealt, positives, negatives, low, high)
    out = spark.createDataFrame([], RESULT)
    for w in range(waves):
        out = out.union(C.settle(_wave(spark, coded, dealt.filter(F.col("wave") == w), positives, negatives, low, high)))
    return out
