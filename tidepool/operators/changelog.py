"""Upsert, time travel and rollback on an append-only change log.

The clean table is stored as an append-only log under ``writer=<who>/batch_id=<n>/event_date=<d>``;
each batch is written by overwriting its own directory, so a retried batch
is idempotent, and streams, backfills and rollbacks number their batches
apart. Every row carries its recency (``kafka_timestamp``,
``kafka_offset``), its ``batch_id``, ``committed_at``, the table
``generation`` (raised by each rollback), ``is_deleted`` and ``operation``.

* version      = a commit. ``commits`` numbers the batches of all writers from 0 in the order of
                 (committed_at, writer, batch_id); a log without ``writer`` has one writer, whose
                 batch numbers are its versions
* current      = latest row per key by (generation, kafka_timestamp, kafka_offset, batch_id),
                 tombstones removed                              (K4, J1)
* as-of v / ts = the same over the commits up to v / ``committed_at <= ts``  (S6, S7)
* history      = one row per commit, newest first                (S8, L2)
* rollback(v)  = append a batch that restates keys changed after v as they were at v
                 and tombstones keys that appeared after v      (K10)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.refine import dedup_latest

KEY = "event_id"
RECENCY = ["generation", "kafka_timestamp", "kafka_offset", "batch_id"]
LOG_META = ["writer", "batch_id", "committed_at", "generation", "is_deleted", "operation"]


def as_log(rows: DataFrame, batch_id: Column | int, committed_at: Column,
           generation: Column | int = 0, operation: str = "MERGE") -> DataFrame:
    """Tag clean rows (with recency columns) as one or more log batches."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)
    return rows.withColumns({
        "batch_id": lit(batch_id).cast("int"),
        # one type for every batch, so batches written apart still merge
        "committed_at": committed_at.cast("timestamp_ntz"),
        "generation": lit(generation).cast("int"),
        "is_deleted": F.lit(False),
        "operation": F.lit(operation),
    })


def current(log: DataFrame, key: str = KEY, keep_meta: bool = False) -> DataFrame:
    """Latest live row per key."""
    latest = dedup_latest(log, key=key, order=RECENCY).filter(~F.col("is_deleted"))
    return latest if keep_meta else latest.drop(*LOG_META)


COMMIT = ["committed_at", "writer", "batch_id"]      # order of the commits of all writers


def commits(log: DataFrame) -> DataFrame:
    """One row per commit (writer and batch) with its ``version``, numbered over all writers.

    Reads the log's few small columns; one row a batch reaches the numbering window.
    """
    grouped = log.groupBy("writer", "batch_id").agg(
        F.max("committed_at").alias("committed_at"),
        F.max("operation").alias("operation"),
        F.max("generation").alias("generation"),
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.col("is_deleted")).alias("num_deleted"),
        F.min("kafka_timestamp").alias("first_event_time"),
        F.max("kafka_timestamp").alias("last_event_time"))
    return grouped.withColumn("version", (F.row_number().over(Window.orderBy(*COMMIT)) - 1).cast("int"))


def _by_writer(known: DataFrame) -> Column:
    """Directories (writer, batch_id) up to each writer's last commit in ``known``: static, so files are pruned.

    One row a writer reaches the driver. A writer's later batches commit later, so none of ``known`` is left out.
    """
    last = known.groupBy("writer").agg(F.max("batch_id").alias("n")).collect()
    reach = F.lit(False)
    for r in last:
        reach = reach | ((F.col("writer") == r["writer"]) & (F.col("batch_id") <= r["n"]))
    return reach


def _upto(log: DataFrame, version: int, known: DataFrame | None = None) -> tuple[Column, Column]:
    """(rows of the commits up to ``version``, a coarser test on directories alone)."""
    if "writer" not in log.columns:
        upto = F.col("batch_id") <= version
        return upto, upto
    known = commits(log) if known is None else known
    cut = known.filter(F.col("version") == version).select(*COMMIT).first()
    if cut is None:
        last = known.agg(F.max("version")).first()[0]
        if last is None or version < 0:
            return F.lit(False), F.lit(False)
        if version > last:
            return F.lit(True), F.lit(True)
    order = F.struct(F.col("committed_at").cast("timestamp_ntz"), F.col("writer"), F.col("batch_id").cast("int"))
    bound = F.struct(F.lit(cut["committed_at"]).cast("timestamp_ntz"), F.lit(cut["writer"]), F.lit(cut["batch_id"]).cast("int"))
    return order <= bound, _by_writer(known.filter(F.col("version") <= version))


def as_of_version(log: DataFrame, version: int, key: str = KEY, known: DataFrame | None = None) -> DataFrame:
    """The table as it was after commit ``version``; ``known`` (stored ``commits``) spares their pass over the log."""
    upto, dirs = _upto(log, version, known)
    return current(log.filter(dirs).filter(upto), key)


def as_of_timestamp(log: DataFrame, ts: str, key: str = KEY) -> DataFrame:
    """The table as it was at time ``ts`` (commits at or before it)."""
    return current(log.filter(F.col("committed_at") <= F.lit(ts).cast("timestamp_ntz")), key)


def history(log: DataFrame, limit: int = 20) -> DataFrame:
    """One row per commit, newest first, at most ``limit`` rows (L2); with several writers also ``version`` and ``writer``."""
    if "writer" in log.columns:
        return commits(log).orderBy(F.col("version").desc()).limit(limit)
    return (commits(log.withColumn("writer", F.lit(""))).drop("writer", "version")
            .orderBy(F.col("batch_id").desc()).limit(limit))


def rollback_batch(log: DataFrame, version: int, committed_at: Column | None = None,
                   key: str = KEY, generation: int | None = None) -> DataFrame:
    """The compensating batch to append so that current == as-of(version).

    Only keys with a row after ``version`` can differ, so only those are
    looked at (a semi-join on the later commits' keys). One shuffle by key
    serves both windows: the first leaves a key's latest row up to the version and
    its latest after it, the second takes of these two the one to restate, or to bury.
    The batch number and generation come from one scalar subquery over the log.
    """
    top = log.select(F.struct((F.max("batch_id") + 1).alias("batch_id"),
                              (F.max("generation") + 1).alias("generation"))).scalar()
    next_gen = F.lit(generation) if generation is not None else top["generation"]
    when = committed_at if committed_at is not None else F.current_timestamp().cast("timestamp_ntz")
    upto, _ = _upto(log, version)
    tagged = log.withColumn("_later", ~upto)
    changed = tagged.filter("_later").select(key).distinct()
    touched = tagged.join(changed, key, "left_semi").repartition(key)
    latest = [F.col(c).desc() for c in RECENCY]
    ends = (touched.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_later").orderBy(*latest)))
            .filter(F.col("_rn") == 1))
    live = ~F.col("is_deleted")
    of_key = Window.partitionBy(key)
    ends = ends.withColumns({"_stood": F.max(~F.col("_later") & live).over(of_key),
                             "_rn": F.row_number().over(of_key.orderBy(*latest))})
    chosen = ends.filter(live & F.when(F.col("_stood"), ~F.col("_later")).otherwise(F.col("_rn") == 1))
    return chosen.withColumns({
        "is_deleted": F.col("_later"),
        "batch_id": top["batch_id"].cast("int"),
        "committed_at": when.cast("timestamp_ntz"),
        "generation": next_gen.cast("int"),
        "operation": F.lit("ROLLBACK"),
    }).select(*log.columns)


def rollback(log: DataFrame, version: int, committed_at: Column | None = None,
             key: str = KEY) -> DataFrame:
    """The log after appending the rollback batch (lazy union)."""
    return log.unionByName(rollback_batch(log, version, committed_at, key).select(*log.columns))


def upsert(target: DataFrame, source: DataFrame, key: str = KEY,
           order: Sequence[str] = ("kafka_timestamp", "kafka_offset")) -> DataFrame:
    """K4 (window/aggregate form): latest row per key over target ∪ source."""
    return dedup_latest(target.unionByName(source), key=key, order=list(order))


def upsert_join(target: DataFrame, source: DataFrame, key: str = KEY) -> DataFrame:
    """J1 (join form, MERGE semantics): source rows win, unmatched target rows kept.

    A shuffle join on the key; AQE turns it into a broadcast only when the
    source side is measured small at runtime.
    """
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def replace_from_min(old: DataFrame, new: DataFrame, column: str = "event_date",
                     only_present: bool = False, since: Column | None = None) -> DataFrame:
    """K6: replace ``old`` from ``min(new[column])`` on (D12); or only the dates present.

    The minimum is a scalar subquery, not a driver collect; ``since`` gives it
    when the caller can take it from something cheaper than ``new``.
    """
    if only_present:
        keep = old.join(new.select(column).distinct(), column, "left_anti")
    else:
        lo = since if since is not None else new.select(F.min(column)).scalar()
        keep = old.filter(F.col(column) < lo)
    return keep.unionByName(new)


def evolve_append(table: DataFrame, batch: DataFrame) -> DataFrame:
    """K9: additive schema evolution; rows of the older schema read NULL."""
    return table.unionByName(batch, allowMissingColumns=True)


# ------------------------------------------------------------------ on disk

PARTITION_BY = ("event_date",)


def log_path(path: str, writer: str, batch_id: int) -> str:
    """Directory of one batch of one writer (``stream``, ``backfill``, ``rollback``)."""
    return f"{path}/writer={writer}/batch_id={int(batch_id)}"


def write_batch(rows: DataFrame, path: str, batch_id: int, writer: str = "stream",
                partition_by: Sequence[str] = PARTITION_BY) -> None:
    """Write one log batch to its directory, overwriting that directory only.

    Retrying the same batch gives the same log (idempotent). Date partitions
    inside every batch let date-range reads prune files in all batches; as-of
    reads prune on ``batch_id``. The directories hold ``writer``, ``batch_id``
    and the partition columns.
    """
    rows.drop("batch_id").write.mode("overwrite").partitionBy(*partition_by).parquet(log_path(path, writer, batch_id))


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log table under its declared schema (no footer is opened to find it),
    with ``writer``, ``batch_id`` and ``event_date`` from the directories."""
    return spark.read.schema(schema).parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: int, writer: str, schema: T.StructType) -> DataFrame:
    """One stored batch with all columns of the log."""
    return spark.read.schema(schema).option("basePath", path).parquet(log_path(path, writer, batch_id))


def write_rollback(spark: SparkSession, path: str, version: int, schema: T.StructType,
                   committed_at: Column | None = None, key: str = KEY) -> int:
    """K10 on disk: write the rollback batch of the stored log; returns its generation.

    Run it between runs of the clean stream, and start the stream again with
    the returned generation, so that its rows win over the restated ones.
    """
    log = read_log(spark, path, schema)
    top = log.agg(F.max("batch_id").alias("batch_id"), F.max("generation").alias("generation")).first()
    generation = int(top["generation"] or 0) + 1
    batch = rollback_batch(log, version, committed_at, key, generation)
    write_batch(batch.drop("writer"), path, int(top["batch_id"]) + 1, "rollback")
    return generation


def as_of_time_batches(log: DataFrame, known: DataFrame, ts: str, key: str = KEY) -> DataFrame:
    """S7 with batch pruning: ``known`` (``commits`` of the log, stored say) maps the time to each writer's
    last batch, and these prune the log's directories. Without ``writer`` in ``known``, batch numbers
    say nothing about other writers' directories, and all are read."""
    if "writer" not in known.columns:
        return as_of_timestamp(log, ts, key)
    at = F.lit(ts).cast("timestamp_ntz")
    return as_of_timestamp(log.filter(_by_writer(known.filter(F.col("committed_at") <= at))), ts, key)
