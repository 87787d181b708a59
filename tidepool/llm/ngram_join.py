"""N-gram Jaccard join by prefix trees, and components of near-equal documents.

A document's set holds its distinct ``WORDS``-word shingles (words are runs without ASCII white space, A-Z
lower-cased); a text with fewer words is one shingle. Two documents are linked when 100 * intersection >= 90 * union.

Method. All sets are put in one global order, rare shingles first: a sketch of ``1 << SKETCH_BITS`` counters,
summed over all documents, gives each shingle a frequency level, and (level, hash) is the order. Sets that are
linked share a shingle among the first n - ceil(0.9 n) + 1 of each. Documents that share such a prefix shingle meet
in Spark by its hash; documents with equal sets travel as one class. Inside a run of classes with one
prefix shingle, a parity bitmap of each set bounds the symmetric difference from below, which drops pairs that
cannot be linked. What is left goes, as whole ordered sets, to a trie (``Trie``): a set is looked up by
walking the tree once, so that sets with a common beginning share the partial overlap, and a subtree is left
as soon as its remaining lengths cannot reach the overlap that is needed. Terminals are exact.

Two rounds keep groups small without losing a link. The first joins every class with the leaders of its runs
(and with the other followers of the same leader). A distributed union-find follows. The second takes every run
that still spans two components, and every pair in it that the bitmaps allow, large runs in blocks of pairs of
blocks, and joins those in tries as well. So every pair that shares a prefix shingle is either joined, ruled out by a
bound, or already in one component. No pairs of a group are listed.

Fixed sizes: the sketch (4 MB of levels) is broadcast; the bitmap of wanted documents (16 MB) too. They do not
grow with the data; if they fill up, prefixes get less selective and more sets travel, with equal results.

Defined cases: null, empty and blank texts have no shingles and are their own component. Rows with one doc_id
are one node; a null doc_id is linked with nothing (null component). Extra columns are ignored.
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

SKETCH_BITS, PIECE = 22, 1 << 14
FLUSH = 1 << 18
LEADER_BLOCK, RUN_BLOCK = 256, 256
NEAREST = 48               # cells up to this size look for each set's nearest, not only for leaders
TOKEN = np.uint64((1 << 56) - 1)
PAIR = np.dtype([("key", "<u8"), ("size", "<u4"), ("cls", "<u8")])


class Join:
    """Parameters: shingle length and similarity as a fraction ``num / den``; both hold for every size of input."""

    def __init__(self, words: int = 3, num: int = 9, den: int = 10):
        self.words, self.num, self.den = words, num, den

    def needed(self, n: int, m: int) -> int:
        """Least overlap of linked sets of n and m: o * den >= num * (n + m - o)."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def may_link(self, n: int, x: int, m: int, y: int) -> bool:
        """False if sizes and parity bitmaps (as integers) rule a link out."""
        if min(n, m) * self.den < self.num * max(n, m):
            return False
        return self.distance(n, x, m, y) <= n + m - 2 * self.needed(n, m)

    @staticmethod
    def distance(n: int, x: int, m: int, y: int) -> int:
        """Members that two sets differ in, at least."""
        p, q = bitmap_size(n), bitmap_size(m)
        while p > q:
            p, x = p // 2, x >> (p // 2) ^ x & ((1 << p // 2) - 1)
        while q > p:
            q, y = q // 2, y >> (q // 2) ^ y & ((1 << q // 2) - 1)
        return (x ^ y).bit_count()


def bitmap_size(n: int) -> int:
    return max(64, 1 << (n // 2).bit_length())


def parity(tokens: np.ndarray) -> bytes:
    """Parity of the set's tokens by hashed place: two sets differ in at least as many members as bits."""
    size = bitmap_size(len(tokens))
    odd = np.bincount(((tokens >> np.uint64(20)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def token_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 56-bit shingle hashes of each text."""
    block = C.Block(texts, lower=True)
    at, h = block.shingles(words)
    h = h >> np.uint64(8)
    cut = np.searchsorted(at, block.first)
    out = []
    for i, n in enumerate(block.n_words):
        if n >= words:
            out.append(C.distinct(h[cut[i]:cut[i + 1]]))
        elif n:
            own = block.words[block.first[i]:block.first[i + 1]]
            out.append(C.chain([own[k:k + 1] for k in range(n)] + [np.full(1, n, np.uint64)]) >> np.uint64(8))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(C.mix(tokens + np.uint64(0x51ED270B)).sum(dtype=np.uint64).view(np.int64))


def ordered(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the global order: frequency level in the top byte, hash below."""
    level = levels[tokens & np.uint64((1 << SKETCH_BITS) - 1)].astype(np.uint64)
    return np.sort(level << np.uint64(56) | tokens)


# ------------------------------------------------------------------ trie

class Node:
    __slots__ = ("part", "children", "least", "most", "ends", "depth")

    def __init__(self, part: np.ndarray, depth: int, size: int):
        self.part, self.depth = part, depth            # tokens on the way in; set members above them
        self.children: dict[int, Node] = {}
        self.least = self.most = size                  # of the sets below
        self.ends: list = []


class Trie:
    """Ordered sets as a path-compressed prefix tree."""

    def __init__(self, rule: Join):
        self.rule, self.root = rule, Node(np.zeros(0, np.uint64), 0, 0)
        self.root.least = 1 << 60

    def add(self, tokens: np.ndarray, name) -> None:
        node, size, at = self.root, len(tokens), 0
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if at == size:
                node.ends.append(name)
                return
            child = node.children.get(int(tokens[at]))
            if child is None:
                leaf = Node(tokens[at:], at, size)
                leaf.ends.append(name)
                node.children[int(tokens[at])] = leaf
                return
            rest = tokens[at:at + len(child.part)]
            differ = np.flatnonzero(child.part[:len(rest)] != rest)
            same = int(differ[0]) if len(differ) else len(rest)
            if same < len(child.part):                 # split the edge
                upper = Node(child.part[:same], at, child.least)
                upper.least, upper.most = child.least, child.most
                upper.children[int(child.part[same])] = child
                child.part, child.depth = child.part[same:], at + same
                node.children[int(tokens[at])] = upper
                child = upper
            node, at = child, at + same

    def matches(self, tokens: np.ndarray, skip) -> Iterator:
        """Names of the sets linked with ``tokens``; ``skip(name)`` tells which need no answer."""
        n = len(tokens)
        stack = [(c, 0, 0) for c in self.root.children.values()]
        while stack:
            node, overlap, at = stack.pop()
            if not node.children and all(skip(x) for x in node.ends):
                continue
            if self.hopeless(node, n, overlap, at, node.depth):
                continue
            place = np.searchsorted(tokens, node.part)
            overlap += int((tokens[np.minimum(place, n - 1)] == node.part).sum())
            at = int(np.searchsorted(tokens, node.part[-1], side="right"))
            size = node.depth + len(node.part)
            for name in node.ends:
                if not skip(name) and overlap >= self.rule.needed(n, size):
                    yield name
            if node.children and not self.hopeless(node, n, overlap, at, size):
                stack += [(c, overlap, at) for c in node.children.values()]

    def hopeless(self, node: Node, n: int, overlap: int, at: int, depth: int) -> bool:
        """No set size below the node can reach the overlap it needs with what remains of both."""
        size = min(max(n - at + depth, node.least), node.most)
        return overlap + min(n - at, size - depth) < self.rule.needed(n, size)


# ------------------------------------------------------------------ tasks

def _described(rule: Join):
    """Per document its size, class and bitmap; per task the counters of its shingles, in compressed pieces."""
    names = ["doc_id", "n", "cls", "bits", "piece", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def batch_of(columns: list, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(rows, k) if c is None else pa.array(c, k) if not isinstance(c, pa.Array) else c
                                           for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for lo, hi, texts in C.chunks(batch):
                sets = token_sets(texts, rule.words)
                every = np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)
                np.add.at(sketch, every, np.uint32(1))
                yield batch_of([batch.column(0).slice(lo, hi - lo), [len(s) for s in sets],
                                [class_of(s) if len(s) else None for s in sets], [parity(s) if len(s) else None for s in sets],
                                None, None], hi - lo)
        pieces = [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(sketch.reshape(-1, PIECE)) if p.any()]
        for i in range(0, len(pieces), 64):
            part = pieces[i:i + 64]
            yield batch_of([None, None, None, None, [p[0] for p in part], [p[1] for p in part]], len(part))
    return run


def _levels(p: pd.DataFrame) -> pd.DataFrame:
    """Four frequency levels per power of two for one piece of the sketch."""
    total = np.zeros(PIECE, np.uint64)
    for c in p["counts"]:
        total += np.frombuffer(zlib.decompress(c), np.uint32)
    return pd.DataFrame({"piece": [p["piece"].iloc[0]], "levels": [(4 * np.log2(total + 1.0)).astype(np.uint8).tobytes()]})


def _prefixes(rule: Join, levels, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = levels.value, [], 0
        for batch in batches:
            for _, _, texts in C.chunks(batch):
                for tokens in token_sets(texts, rule.words):
                    if not len(tokens):
                        continue
                    first = ordered(tokens, known)[:rule.prefix(len(tokens))]
                    pairs = np.empty(len(first), PAIR)
                    pairs["key"], pairs["size"] = C.mix(first & TOKEN), len(tokens)
                    pairs["cls"] = np.uint64(class_of(tokens) & (1 << 64) - 1)
                    held.append(pairs)
                    size += len(first)
                if size >= FLUSH:
                    yield C.packed(np.concatenate(held), width, "key")
                    held, size = [], 0
        if held:
            yield C.packed(np.concatenate(held), width, "key")
    return run


def _shared_keys(rule: Join):
    """(key, cls, first, run) of classes that share a prefix shingle with one of a size that allows a link.

    In the order of sizes only neighbours need a look. ``first`` is the run's smallest set, ``run`` its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = C.shared(batches, PAIR, "key")
        size = pairs["size"].astype(np.int64)
        near = (pairs["key"][1:] == pairs["key"][:-1]) & (size[:-1] * rule.den >= size[1:] * rule.num)
        pairs = pairs[np.append(near, False) | np.insert(near, 0, False)] if len(pairs) else pairs
        group = C.run_of(pairs["key"])
        length = np.bincount(group)[group] if len(group) else group
        yield from C.columns({"key": pairs["key"], "cls": pairs["cls"], "first": pairs["cls"][np.searchsorted(group, group)],
                              "run": length.astype(np.int64)})
    return run


def _pairs(links: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in range(len(names))], names=names)


def _led(rule: Join):
    """(cls, leader) for each run's cell: the first leader that may be linked, and in small cells the nearest set before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _several(C.groups(batches, 2), 2000):
            out = set()
            for _, rows in some:
                sets = sorted((r[3], r[2], int.from_bytes(r[4], "little")) for r in rows)
                leaders: list[tuple] = []
                for i, (n, cls, bits) in enumerate(sets):
                    before = sets[:i] if len(sets) <= NEAREST else leaders
                    fit = [x for x in before if rule.may_link(x[0], x[2], n, bits)]
                    if not any(x[1] == y[1] for x in fit for y in leaders):
                        leaders.append((n, cls, bits))
                    if fit:
                        out.add((cls, fit[0][1]))
                        out.add((cls, min(fit, key=lambda x: (rule.distance(x[0], x[2], n, bits), x[1]))[1]))
            yield _pairs([x for x in out if x[0] != x[1]], ["cls", "leader"])
    return run


def _open(rule: Join):
    """(cell, cls) of the members of a cell that may be linked with a member of another component.

    The cell's name is a hash of those members, so runs that leave the same question open ask it once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _several(C.groups(batches, 3), 2000):
            out = set()
            for (_, lo, hi), rows in some:
                x = [(r[3], r[4], r[5], int.from_bytes(r[6], "little"), r[7]) for r in rows]
                members = set()
                for i in range(len(x)):
                    for j in range(i):
                        a, b = x[i], x[j]
                        if a[4] != b[4] and (lo == hi or a[1] != b[1]) and rule.may_link(a[2], a[3], b[2], b[3]):
                            members |= {a[0], b[0]}
                if members:
                    name = int(C.chain([np.array([m], np.int64).view(np.uint64) for m in sorted(members)]).view(np.int64)[0])
                    out |= {(name, m) for m in members}
            yield _pairs(list(out), ["cell", "cls"])
    return run


def _several(items: Iterator, size: int) -> Iterator[list]:
    held = []
    for x in items:
        held.append(x)
        if len(held) >= size:
            yield held
            held = []
    yield held


def _wanted_sets(rule: Join, levels, found):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, want = levels.value, found.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            hit = C.in_bitmap(want, ids)
            few = batch.filter(pa.array(hit))
            for _, _, texts in C.chunks(few):
                sets = [s for s in token_sets(texts, rule.words) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.int64()),
                                                  pa.array([ordered(s, known).tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])
    return run


def _joined(rule: Join):
    """Links that connect components inside each cell, by one trie a cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in C.groups(batches, 2):
            sets = {r[2]: (np.frombuffer(r[4], np.uint64), r[3]) for r in rows}
            parent = {c: c for _, c in sets.values()}

            def find(c: int) -> int:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            tree, links = Trie(rule), []
            for cls, (tokens, component) in sorted(sets.items(), key=lambda x: len(x[1][0])):
                for other, theirs in tree.matches(tokens, lambda x, c=component: find(x[1]) == find(c)):
                    a, b = find(component), find(theirs)
                    if a != b:
                        parent[a] = b
                        links.append((cls, other))
                tree.add(tokens, (cls, component))
            yield _pairs(links, ["a", "b"])
    return run


# ------------------------------------------------------------------ operator

def near_equal(docs: DataFrame, rule: Join | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    rule = rule or Join()
    spark = docs.sparkSession
    texts = C.doc_texts(docs)
    width = max(8, C.shuffle_width(spark))
    told = C.settle(texts.mapInArrow(_described(rule), "doc_id long, n long, cls long, bits binary, piece int, counts binary"))
    info = told.filter("n is not null").select("doc_id", "n", "cls")
    classes = C.settle(told.filter("cls is not null and doc_id is not null").groupBy("cls").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits")))

    pieces = told.filter("piece is not null").select("piece", "counts").groupBy("piece").applyInPandas(_levels, "piece int, levels binary")
    table = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in pieces.toLocalIterator():
        table[r["piece"] * PIECE:(r["piece"] + 1) * PIECE] = np.frombuffer(r["levels"], np.uint8)
    levels = spark.sparkContext.broadcast(table)

    keys = C.settle(texts.filter("doc_id is not null").mapInArrow(_prefixes(rule, levels, width), "bucket int, pairs binary")
                    .repartition(width, "bucket").mapInArrow(_shared_keys(rule), "key long, cls long, first long, run long"))

    # a long run is dealt to cells, with its smallest set in each
    described = classes.select("cls", "n", "bits")
    pieces = F.ceil(F.col("run") / RUN_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), pieces).cast("int")
    cell = F.explode(F.when(F.col("cls") == F.col("first"), F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(own)))
    led = C.settle(keys.select("key", "cls", cell.alias("block")).join(described, "cls").select("key", "block", "cls", "n", "bits")
                   .repartition("key", "block").sortWithinPartitions("key", "block")
                   .mapInArrow(_led(rule), "cls long, leader long").distinct())

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Ordered sets of the classes; read from the documents again, each class from its first one."""
        need = wanted.select("cls").distinct()
        bits = C.bitmap(need.join(classes, "cls"), "first")
        found = spark.sparkContext.broadcast(bits)
        return (texts.filter("doc_id is not null").mapInArrow(_wanted_sets(rule, levels, found), "cls long, tokens binary"))

    # first round: leaders with their followers; a popular leader stands in each block of its followers
    blocks = led.groupBy("leader").agg(F.ceil(F.count("*") / LEADER_BLOCK).cast("int").alias("blocks"))
    dealt = led.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    stand = blocks.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("leader").alias("cls"))
    seats = C.settle(dealt.select("leader", "block", "cls").union(stand))
    links = C.settle(seats.join(sets_of(seats), "cls")
                     .select("leader", "block", "cls", F.col("cls").alias("component"), "tokens")
                     .repartition("leader", "block").sortWithinPartitions("leader", "block")
                     .mapInArrow(_joined(rule), "a long, b long"))
    known = C.settle(C.components(links)).withColumnRenamed("node", "cls")

    # second round: runs that still span components
    placed = keys.join(known, "cls", "left").select("key", "cls", F.coalesce("component", "cls").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    rest = C.settle(C.block_pairs(placed.join(split, "key", "left_semi"), "key", "cls", RUN_BLOCK).join(described, "cls")
                    .select("key", "lo", "hi", "cls", "block", "n", "bits", "component")
                    .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
                    .mapInArrow(_open(rule), "cell long, cls long").distinct())
    if not rest.isEmpty():
        again = (rest.join(known, "cls", "left").withColumn("component", F.coalesce("component", "cls")).join(sets_of(rest), "cls")
                 .select("cell", F.lit(0).alias("part"), "cls", "component", "tokens")
                 .repartition("cell").sortWithinPartitions("cell"))
        links = links.union(again.mapInArrow(_joined(rule), "a long, b long"))
    found = C.settle(C.components(links).withColumnRenamed("node", "cls"))

    named = info.join(found, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    first = classes.join(found, "cls", "left").groupBy(F.coalesce("component", "cls").alias("component")).agg(F.min("first").alias("least"))
    return named.join(first, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))

