"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Every source's documents are put in a keyed random order and cut into blocks of ``BLOCK_CHARS`` code points
(a document belongs to the block in which it begins). With weights that are whole shares a_i of a period of
``PERIOD`` slots, block k of a source is released at slot floor(k * PERIOD / a_i) and due before slot
ceil((k + 1) * PERIOD / a_i). In each slot the released block with the earliest deadline is taken. That is the
Pfair schedule: after every slot t each source has given more than t * a_i / PERIOD - 1 and less than
t * a_i / PERIOD + 1 blocks. The schedule repeats after a period, in which each source gives exactly a_i blocks; so
the period alone is scheduled (``PERIOD`` heap steps, whatever the data's size) and a block's slot in the whole
corpus follows from its number by arithmetic and a join with the period's table.

The schedule runs until every source has given all of its blocks at least once; sources that end sooner start
over (``epoch`` 1, 2, ...), as far as their share of the remaining slots goes. So no document is dropped, and the
weights hold for the whole schedule. Default weights: each source's blocks to the power ``TEMPERATURE``.

Numbering blocks needs running sums within a source. They are taken in two levels: documents fall into bins by the
leading bits of their order key, bins are summed first, and running sums run within a bin and over bins; a source with a
third of all rows is spread over as many bins as it needs.

Defined cases: a null source is a source of its own. Null or empty texts count as one code point. Ties in the
order key are broken by doc_id, then by the other columns' hash; repeated rows are scheduled each. Given
weights name sources; sources without one, or with a weight of zero or less, get the least share (one slot a period).
The period has ``PERIOD`` slots, or with more sources than that, the power of two from twice their number on; so any number of sources is
mixed. One row a source and one a slot of the period reach the driver. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import common as C

PERIOD = 4096
BLOCK_CHARS = 1 << 16
TEMPERATURE = 0.85
BIN_ROWS = 20_000          # documents of one source in a bin, about
SEED = 42
SALTS = 32                 # parts of a source's rows where the sources are too many to broadcast


def period_for(sources: int) -> int:
    """Slots of the period: every source needs one at least, and as many again leave room for the weights."""
    return PERIOD if sources <= PERIOD else 1 << (2 * sources - 1).bit_length()


def _beside(rows: DataFrame, table: DataFrame, on: list[str], small: bool) -> DataFrame:
    """``rows`` with the columns of a table by source: broadcast where it is ``small``, else joined by source and a salt, so that
    a source with a third of all rows is many groups."""
    if small:
        return rows.join(F.broadcast(table), on)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64("__id", "__order"), F.lit(SALTS)).cast("int")).join(salted, [*on, "__salt"]).drop("__salt")


def shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole shares of a period, at least 1 each, nearest to the weights (largest remainders)."""
    total = sum(weights.values())
    exact = {s: (period - len(weights)) * w / total for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:period - sum(out.values())]:
        out[s] += 1
    return out


def period_schedule(share: dict[str, int], period: int = PERIOD) -> list[tuple[str, int, int, int, int]]:
    """(source, k, release, deadline, slot) of every block of one period, earliest deadline first."""
    future = [(0, -(-period // a), s, 0) for s, a in sorted(share.items())]      # release, deadline, source, k
    heapq.heapify(future)
    ready: list[tuple[int, str, int, int]] = []
    out = []
    for slot in range(period):
        while future and future[0][0] <= slot:
            release, deadline, s, k = heapq.heappop(future)
            heapq.heappush(ready, (deadline, s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline is missed")
        out.append((s, k, release, deadline, slot))
        a = share[s]
        if k + 1 < a:
            heapq.heappush(future, ((k + 1) * period // a, -(-(k + 2) * period // a), s, k + 1))
    return out


def blocks(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__source`` (never null), ``__block`` (from 0 within its source) and ``__order``."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = C.settle(docs.withColumns({
        "__source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        "__size": F.greatest(F.coalesce(F.length(F.col("text").cast("string")), F.lit(1)), F.lit(1)).cast("long"),
        "__order": F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")), "__whole": whole})
        .select("__source", "__size", "__order", "__whole", F.col("doc_id").cast("long").alias("__id")))
    counts = keyed.groupBy("__source").agg(F.ceil(F.count("*") / BIN_ROWS).alias("__bins"))
    # leading 31 bits of the key (made unsigned), scaled to the source's number of bins: bins rise with the key
    lead = F.shiftrightunsigned(F.col("__order").bitwiseXOR(F.lit(-1 << 63)), 33)
    counts = C.settle(counts)
    # a join by source alone would leave a source's rows together
    binned = _beside(keyed, counts, ["__source"], counts.count() <= PERIOD).withColumn("__bin", F.shiftright(lead * F.col("__bins"), 31)).drop("__bins")
    sums = binned.groupBy("__source", "__bin").agg(F.sum("__size").alias("n"))
    over = W.partitionBy("__source").orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(F.col("__source").alias("s"), F.col("__bin").alias("b"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("__before"))
    within = W.partitionBy("__source", "__bin").orderBy("__order", "__id", "__whole")
    start = F.sum("__size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")
    placed = (binned.withColumn("__start", start)
              .join(before, (F.col("__source") == F.col("s")) & (F.col("__bin") == F.col("b"))))
    return placed.select("__id", "__whole", "__source", "__order",
                         F.floor((F.col("__before") + F.col("__start")) / BLOCK_CHARS).alias("__block"))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """One row per document and epoch: __id, __whole, __source, __block, __epoch, __slot, __release, __deadline, __order."""
    spark = docs.sparkSession
    rows = C.settle(blocks(docs, seed))
    sizes = {r["__source"]: r["n"] for r in rows.groupBy("__source").agg((F.max("__block") + 1).alias("n")).collect()}     # a row a source
    table, period, small = _table(spark, sizes, weights), period_for(len(sizes)), len(sizes) <= PERIOD
    jobs = _beside(rows, table.select("__source", "__blocks", "__given", "__share").distinct(), ["__source"], small)
    epochs = F.sequence(F.lit(0), F.floor((F.col("__given") - 1) / F.col("__blocks")).cast("int"))
    runs = (jobs.withColumn("__epoch", F.explode(epochs))
            .withColumn("__number", F.col("__epoch") * F.col("__blocks") + F.col("__block"))
            .filter("__number < __given"))
    place = table.select("__source", "__k", "__share", "__at", "__from", "__to")
    turn = F.floor(F.col("__number") / F.col("__share")) * period
    # the period's table has a row a slot
    return (_beside(runs.withColumn("__k", F.col("__number") % F.col("__share")), place.drop("__share"), ["__source", "__k"], small)
            .select("__id", "__whole", "__source", "__block", "__epoch", "__order",
                    (turn + F.col("__at")).alias("__slot"), (turn + F.col("__from")).alias("__release"), (turn + F.col("__to")).alias("__deadline")))


def _table(spark: SparkSession, sizes: dict[str, int], weights: dict[str, float] | None) -> DataFrame:
    """The period's schedule (``PERIOD`` rows) with each source's blocks, share and blocks to give in all."""
    if weights is None:
        wanted = {s: n ** TEMPERATURE for s, n in sizes.items()}
    else:
        wanted = {s: max(0.0, weights.get(s[1:], 0.0) if s else 0.0) for s in sizes}
        if not any(wanted.values()):
            wanted = dict.fromkeys(sizes, 1.0)
    rows = []
    if sizes:
        period = period_for(len(sizes))
        share = shares(wanted, period)
        plan = period_schedule(share, period)
        order: dict[str, list[tuple]] = {}
        for s, k, release, deadline, slot in plan:
            order.setdefault(s, []).append((k, release, deadline, slot))
        # the slot after which every source has given each of its blocks
        end = max((n - 1) // share[s] * period + order[s][(n - 1) % share[s]][3] + 1 for s, n in sizes.items())
        for s, ks in order.items():
            given = end // period * share[s] + sum(x[3] < end % period for x in ks)
            rows += [(s, k, share[s], sizes[s], given, slot, release, deadline) for k, release, deadline, slot in ks]
    return spark.createDataFrame(rows, "__source string, __k long, __share long, __blocks long, __given long, __at long, __from long, __to long")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """The columns of ``docs``, each document once per epoch, in the order of the schedule.

    Rows are range-partitioned and sorted by slot, so the files that are written hold consecutive slots.
    """
    # repeated rows are one plan row an epoch; the join gives each of them its place
    once = schedule(docs, weights, seed).groupBy(F.col("__id").alias("__pid"), F.col("__whole").alias("__pwhole"), "__epoch").agg(
        F.min("__slot").alias("__slot"), F.min("__order").alias("__porder"))
    every = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*every).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(*every).alias("whole"))
    joined = rows.join(once, F.col("id").eqNullSafe(F.col("__pid")) & (F.col("whole") == F.col("__pwhole")))
    return joined.repartitionByRange("__slot", "__porder").sortWithinPartitions("__slot", "__porder").select("row.*")
