"""Nearest neighbours by balanced posting lists, replicated boundaries and a graph over centroids.

A bounded sample of the vectors (``SAMPLE_CELLS`` numbers, smallest vector hashes) is split again and again at
the median of its main spread until there is a centroid for about every ``LIST`` vectors (at most ``CENTROIDS``); the median
keeps lists balanced. The centroids form a proximity graph that every task holds in memory and walks best-first.
Every vector goes to its nearest list and, near a boundary, to further ones: those within ``1 + SPREAD`` times the
nearest distance, unless a list already chosen is closer to that centroid than the vector is, ``REPLICAS`` at most
(a replica is redundant: the nearest list always has the vector). A query first probes the lists whose centroids lie
within ``RATIO`` times its nearest centroid's distance, ``PROBES`` at most, and every vector of these lists is
compared exactly, in double precision.

What the probes leave out is settled by a bound: a list whose centroid lies further than the query's distance to its
last neighbour so far plus the list's radius (over the vectors that have it as their nearest list) holds nothing
nearer. All other lists are scanned in a second round, so the answers are the true neighbours at any number of
lists; ``RATIO`` and ``PROBES`` only say how much is done in which round. In data without clusters the bound excludes
few lists, and the work is near that of comparing each query with everything.

Equal vectors travel as one, with the ``KEEP`` smallest of their ids: no more of them can be in an answer, since
ties go to the smaller id. So a vector that a third of all rows share costs one entry. A list that has grown over ``PART``
vectors is split among tasks by the vector's hash, and its queries go to each part.

Fixed sizes: the sample on the driver, and centroids and graph in the broadcast (``CENTROIDS`` at most).

Defined cases: vectors that are null, all zero, or hold a null or non-finite number take no part, nor do rows with
a null id or a length other than the most frequent one. With fewer candidates than asked for, all found are
returned. Rows with the same id are never each other's neighbours; repeated rows count once. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import common as C

SAMPLE_CELLS = 1 << 21
LIST, CENTROIDS = 256, 4096
SPREAD, REPLICAS = 0.15, 6
RATIO, PROBES, EFFORT = 1.35, 48, 64
DEGREE = 16
PART = 4096
PACK = 256                 # queries that travel to a list in one row, at most


def balanced_centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Means of k parts of nearly equal size, by halving the largest part at the median of its widest direction."""
    heap = [(-len(sample), 0, np.arange(len(sample)))]
    made = 1
    while len(heap) < k and -heap[0][0] > 1:
        _, _, rows = heapq.heappop(heap)
        x = sample[rows] - sample[rows].mean(axis=0)
        axis = x[np.argmax((x * x).sum(axis=1))]
        for _ in range(8):                             # power steps towards the widest direction
            step = x.T @ (x @ axis)
            norm = np.sqrt(step @ step)
            if norm == 0:
                break
            axis = step / norm
        order = np.argsort(x @ axis, kind="stable")
        for half in (order[:len(order) // 2], order[len(order) // 2:]):
            heapq.heappush(heap, (-len(half), made, rows[half]))
            made += 1
    return np.stack([sample[rows].mean(axis=0) for _, _, rows in sorted(heap, key=lambda h: h[1])])


class Graph:
    """Proximity graph over centroids: nearest neighbours both ways, plus links that make it connected."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        square = (points * points).sum(axis=1)
        links: list[set[int]] = [set() for _ in range(n)]
        for lo in range(0, n, 512):
            d = square[None, :] - 2 * points[lo:lo + 512] @ points.T
            near = np.argsort(d, axis=1)[:, :DEGREE + 1]
            for i, row in enumerate(near.tolist(), lo):
                for j in row:
                    if j != i:
                        links[i].add(j)
                        links[j].add(i)
        self.entry = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
        seen: set[int] = set()
        for start in [self.entry, *range(n)]:
            if start in seen:
                continue
            if start != self.entry:
                links[start].add(self.entry)
                links[self.entry].add(start)
            todo = [start]
            while todo:
                i = todo.pop()
                if i not in seen:
                    seen.add(i)
                    todo += links[i] - seen
        self.links = [np.array(sorted(x), np.int64) for x in links]

    def nearest(self, q: np.ndarray, effort: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of about the ``effort`` nearest, nearest first, by best-first walk."""
        seen = np.zeros(len(self.points), bool)
        seen[self.entry] = True
        d = float(np.sqrt(((self.points[self.entry] - q) ** 2).sum()))
        todo, best = [(d, self.entry)], [(-d, self.entry)]
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= effort and d > -best[0][0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            if not len(new):
                continue
            seen[new] = True
            dist = np.sqrt(((self.points[new] - q) ** 2).sum(axis=1))
            for x, j in zip(dist.tolist(), new.tolist(), strict=True):
                if len(best) < effort or x < -best[0][0]:
                    heapq.heappush(todo, (x, j))
                    heapq.heappush(best, (-x, j))
                    if len(best) > effort:
                        heapq.heappop(best)
        found = sorted((-x, j) for x, j in best)
        return np.array([j for _, j in found]), np.array([x for x, _ in found])

    def lists_of(self, v: np.ndarray) -> list[int]:
        """Nearest list, and those across nearby boundaries that no chosen list stands before."""
        at, dist = self.nearest(v, 4 * REPLICAS)
        chosen = [int(at[0])]
        for j, d in zip(at[1:].tolist(), dist[1:].tolist(), strict=True):
            if d > (1 + SPREAD) * dist[0] or len(chosen) == REPLICAS:
                break
            gaps = np.sqrt(((self.points[chosen] - self.points[j]) ** 2).sum(axis=1))
            if (gaps > d).all():
                chosen.append(j)
        return chosen

    def open_lists(self, q: np.ndarray, radius: np.ndarray, last: float) -> np.ndarray:
        """Lists beyond the probes that can hold a vector as near as ``last``."""
        dist = np.sqrt(((self.points - q) ** 2).sum(axis=1))
        can = (radius >= 0) & (dist - radius <= last + 1e-9 * (dist + radius))
        can[self.probes_of(q)] = False
        return np.flatnonzero(can)

    def probes_of(self, q: np.ndarray) -> list[int]:
        at, dist = self.nearest(q, EFFORT)
        return at[dist <= RATIO * dist[0]][:PROBES].tolist()


def _lists(graph, kind: int):
    """Rows (list, kind, name, v, ids, reach): a vector's lists (kind 0) or a query's probes (kind 1).

    ``reach`` is a vector's distance to its nearest list's centroid, null in other rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = [g.lists_of(x) if kind == 0 else g.probes_of(x) for x in v]
            at = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            blobs = [x.tobytes() for x in v]
            reach = [float(np.sqrt(((g.points[j] - x) ** 2).sum())) if kind == 0 and n == 0 else None
                     for f, x in zip(found, v, strict=True) for n, j in enumerate(f)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([j for f in found for j in f], pa.int32()), pa.array(np.full(len(at), kind), pa.int32()), batch.column(0).take(pa.array(at)),
                 pa.array([blobs[i] for i in at], pa.binary()), batch.column(2).take(pa.array(at)),
                 pa.array(reach, pa.float64())], names=["list", "kind", "name", "v", "ids", "reach"])
    return run


def _rest(graph, radius):
    """Rows (list, v, names, lasts): the queries (their vectors, names and bounds) that a further list must answer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        for whole in batches:
            for lo in range(0, whole.num_rows, PACK):
                batch = whole.slice(lo, PACK)
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                names, lasts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
                asked: dict[int, list[int]] = {}
                for i, (x, last) in enumerate(zip(v, lasts.tolist(), strict=True)):
                    for j in g.open_lists(x, radius, last).tolist():
                        asked.setdefault(j, []).append(i)
                lists = sorted(asked)
                for at in range(0, len(lists), 64):
                    some = lists[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int32()), pa.array([v[asked[j]].tobytes() for j in some], pa.binary()),
                         pa.array([names[asked[j]] for j in some], pa.list_(pa.int64())), pa.array([lasts[asked[j]] for j in some], pa.list_(pa.float64()))],
                        names=["list", "v", "names", "lasts"])
    return run


def _scan_rest(keep: int):
    """Per list part and query, the vectors of the part that are no further than the query's bound, ``keep`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, matrix, square, names, ids = None, [], None, None, [], []
        for batch in batches:
            out: list[tuple] = []
            for lst, number, kind, name, v, own, asking, lasts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lst, number) != part:
                    part, held, names, ids, matrix = (lst, number), [], [], [], None
                if kind == 0:
                    held.append(np.frombuffer(v, "<f8"))
                    names.append(name)
                    ids.append(own)
                elif held:
                    if matrix is None:
                        matrix = np.stack(held)
                        square = (matrix * matrix).sum(axis=1)
                    q = np.frombuffer(v, "<f8").reshape(len(asking), -1)
                    size = square[:, None] + (q * q).sum(axis=1)[None, :]
                    rough = size - 2 * matrix @ q.T                  # squared, with a rounding error far below the margin
                    could = rough <= np.square(lasts)[None, :] * (1 + 1e-9) + 1e-9 * size
                    for j in np.flatnonzero(could.any(axis=0)).tolist():
                        at = np.flatnonzero(could[:, j])
                        d = np.sqrt(((matrix[at] - q[j]) ** 2).sum(axis=1))
                        best = sorted((x, ids[i][0], i) for x, i in zip(d.tolist(), at.tolist(), strict=True) if x <= lasts[j])[:keep]
                        out += [(asking[j], names[i], x, ids[i]) for x, _, i in best]
            yield _found(out)
    return run


def _found(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                       pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                                      names=["query", "name", "score", "ids"])


def _scan(keep: int):
    """Per list part and query, the nearest vectors of the part; only the part's vectors are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, matrix, names, ids = None, [], None, [], []
        for batch in batches:
            out: list[tuple] = []
            for lst, number, kind, name, v, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lst, number) != part:
                    part, held, names, ids, matrix = (lst, number), [], [], [], None
                if kind == 0:
                    held.append(np.frombuffer(v, "<f8"))
                    names.append(name)
                    ids.append(own)
                elif held:
                    if matrix is None:
                        matrix = np.stack(held)
                    d = np.sqrt(((matrix - np.frombuffer(v, "<f8")) ** 2).sum(axis=1))
                    if len(d) > keep:
                        near = np.flatnonzero(d <= np.partition(d, keep - 1)[keep - 1])
                    else:
                        near = np.arange(len(d))
                    best = sorted((d[i], ids[i][0], i) for i in near.tolist())[:keep]
                    out += [(name, names[i], float(x), ids[i]) for x, _, i in best]
            yield _found(out)
    return run


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, h, v): rows that take part, vectors as doubles with their hash."""
    good = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    good = good.withColumn("v", F.transform("v", lambda x: x + 0.0))          # -0.0 equals 0.0
    size = good.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).select("n").scalar()
    return good.filter(F.size("v") == size).withColumn("h", F.xxhash64("v")).distinct()


def _nearest(found: DataFrame) -> DataFrame:
    """Each vector once a query: replicas meet the same query in several lists, always at the same distance."""
    return found.groupBy("query", "name").agg(F.min("score").alias("score"), F.first("ids").alias("ids"))


def _top(near: DataFrame, keep: int) -> DataFrame:
    each = near.select("query", "score", F.explode("ids").alias("vec_id"))
    return each.withColumn("at", F.row_number().over(W.partitionBy("query").orderBy("score", "vec_id"))).filter(F.col("at") <= keep)


def search(rows: DataFrame, queries, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row where the Column ``queries`` (over vec_id) holds."""
    spark = rows.sparkSession
    base = C.settle(usable(rows, id_column, vector_column))
    first = F.row_number().over(W.partitionBy("h", "v").orderBy("vec_id"))
    vectors = C.settle(base.withColumn("at", first).filter(F.col("at") <= k + 1).groupBy("h", "v")
                       .agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("name", F.monotonically_increasing_id()))
    count = vectors.count()
    head = vectors.select(F.size("v").alias("n")).head()
    out = "query_id long, rank int, vec_id long, score double"
    if head is None:
        return spark.createDataFrame([], out)
    limit = max(1, SAMPLE_CELLS // head["n"])
    sample = np.array([r["v"] for r in vectors.orderBy("h").limit(limit).select("v").toLocalIterator()])
    lists = min(CENTROIDS, max(1, -(-count // LIST)), max(1, len(sample) // 4))
    graph = spark.sparkContext.broadcast(Graph(balanced_centroids(sample, lists)))

    row = "list int, kind int, name long, v binary, ids array<long>, reach double"
    postings = C.settle(vectors.select("name", "v", "ids").mapInArrow(_lists(graph, 0), row))
    asked = base.filter(queries).select(F.col("vec_id").alias("query_id"), "h", "v")
    named = asked.join(vectors.select("h", "v", "name"), ["h", "v"]).select("query_id", "name")
    named = C.settle(named)
    once = named.select("name").distinct().join(vectors, "name").select("name", "v", F.array().cast("array<long>").alias("ids"))
    probes = once.repartition(C.shuffle_width(spark), "name").mapInArrow(_lists(graph, 1), row)

    # at most CENTROIDS rows
    parts = F.broadcast(postings.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    dealt = postings.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("name"), "parts").cast("int"))
    spread = probes.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = dealt.drop("parts").unionByName(spread.drop("parts")).select("list", "part", "kind", "name", "v", "ids")
    found = (both.repartition("list", "part").sortWithinPartitions("list", "part", "kind")
             .mapInArrow(_scan(k + 1), "query long, name long, score double, ids array<long>"))
    near = C.settle(_nearest(found))
    top = _top(near, k + 1)

    # the distance that a further list must beat; infinite with too few found
    lasts = top.groupBy("query").agg(F.max("score").alias("score"), F.count("*").alias("n")).select(
        F.col("query").alias("name"), F.when(F.col("n") > k, F.col("score")).alias("last"))
    waiting = once.join(lasts, "name", "left").select("name", "v", F.coalesce("last", F.lit(float("inf"))).alias("last"))
    radius = np.full(lists, -1.0)
    for r in postings.groupBy("list").agg(F.max("reach").alias("reach")).filter("reach is not null").toLocalIterator():
        radius[r["list"]] = r["reach"]
    none = F.lit(None)
    packs = (waiting.repartition(C.shuffle_width(spark), "name").mapInArrow(_rest(graph, radius), "list int, v binary, names array<long>, lasts array<double>")
             .join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("list", "part", F.lit(1).alias("kind"), none.cast("long").alias("name"), "v", none.cast("array<long>").alias("ids"), "names", "lasts"))
    # vectors count in their nearest list only, which the radius is about
    own = dealt.filter("reach is not null").select("list", "part", "kind", "name", "v", "ids", none.cast("array<long>").alias("names"),
                                                   none.cast("array<double>").alias("lasts"))
    more = (own.unionByName(packs).repartition("list", "part").sortWithinPartitions("list", "part", "kind")
            .mapInArrow(_scan_rest(k + 1), "query long, name long, score double, ids array<long>"))
    top = _top(_nearest(near.unionByName(more)), k + 1)
    answers = named.join(top, named["name"] == top["query"]).filter("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (answers.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
