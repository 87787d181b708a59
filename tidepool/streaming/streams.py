"""Structured Streaming: raw → clean → KPI.

Three queries linked only by tables, as in the reference, each with its own
checkpoint:

1. ``bronze_stream``: ``foreachBatch`` that parses Kafka-shaped records, adds
   bronze metadata and writes the epoch to
   ``bronze/batch_id=<epoch>/event_date=…/event_hour=…`` by overwriting that
   batch directory (retry-safe; the epoch number is the batch id, D8). Rows of
   an hour are dealt to a fixed number of writers.
2. ``clean_stream``: ``foreachBatch`` over the bronze table: split dead
   letters, ``refine``, and write the batch to
   ``log/writer=stream/batch_id=<epoch>`` by overwriting that directory, so a
   retried epoch is idempotent. Stage counters come from ``Observation``s on
   the writes themselves (no extra pass) and go to a run-metrics table.
3. ``kpi_stream``: sliding-window KPIs over the change log with a
   watermark; distinct users are exact through two chained aggregations
   (window, type, user) → (window, type), in append mode (D1, D2).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidepool.operators import changelog, current_table, refine
from tidepool.sources import ingest, record_source

# State store settings for large keyed state (de-duplication by event id and
# per-user window aggregates within the watermark): RocksDB keeps it off the
# JVM heap; changelog checkpointing uploads only the changes of each batch.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
KPI_TRIGGER = {"processingTime": "30 seconds"}
WATERMARK = "10 minutes"


def configure_streaming(spark: SparkSession) -> dict:
    """Apply ``STREAMING_CONF`` where the session has not chosen otherwise.

    Must run before a query's first start: a checkpoint keeps the provider
    it was created with. Returns the settings in force.
    """
    out = {}
    for k, v in STREAMING_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
        out[k] = spark.conf.get(k)
    return out


def _with_trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def _nullable(schema: T.StructType) -> T.StructType:
    # files read back are nullable whatever the writer's plan said
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


BRONZE_PARTITIONS = ["event_date", "event_hour"]
WRITERS = 8       # tasks that write one hour (bronze) or one date (clean log) of a batch


def bronze_schema(spark: SparkSession) -> T.StructType:
    """Schema of the bronze table (payload + envelope + metadata; ``batch_id``,
    ``event_date`` and ``event_hour`` come from the directories)."""
    empty = spark.createDataFrame([], ingest.RECORD_SCHEMA)
    return _nullable(ingest.enrich_raw(ingest.parse_records(empty), "x").schema)


def log_schema(spark: SparkSession) -> T.StructType:
    """Schema of the change log as read back (``batch_id`` from the directory)."""
    empty = spark.createDataFrame([], bronze_schema(spark))
    rows = refine.refine(empty.drop(ingest.CORRUPT_COLUMN), keep_order=True)
    logged = changelog.as_log(rows, 0, F.current_timestamp().cast("timestamp_ntz"))
    return _nullable(logged.schema).add("writer", T.StringType())


# ------------------------------------------------------------------ 1. bronze

def write_bronze_batch(enriched: DataFrame, batch_id: str, path: str, writers: int = WRITERS) -> int:
    """Write one batch of bronze rows to ``path/batch_id=<batch_id>``; returns rows written.

    Overwriting the batch directory makes a retried batch idempotent. Rows
    are shuffled by (event_date, event_hour, salt), the salt being a hash of
    the Kafka coordinates below ``writers``, so a batch that is all "current
    hour" is written by several tasks, whatever its size.
    """
    salt = F.pmod(F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset"), F.lit(writers))
    obs = Observation(f"bronze_{batch_id}")
    out = (enriched.drop("batch_id")
           .repartition(*[F.col(c) for c in BRONZE_PARTITIONS], salt)
           .observe(obs, F.count(F.lit(1)).alias("n")))
    out.write.mode("overwrite").partitionBy(*BRONZE_PARTITIONS).parquet(f"{path}/batch_id={batch_id}")
    return int(obs.get["n"])


def _count_row(spark: SparkSession, metrics_path: str | None, batch: str, counters: dict) -> None:
    """M1: one row of stage counters, in the batch's own directory (a retry overwrites it)."""
    if metrics_path:
        spark.createDataFrame([counters]).write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch}")


def bronze_stream(records: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None, source_system: str = ingest.DEFAULT_SOURCE_SYSTEM,
                  writers: int = WRITERS, metrics_path: str | None = None,
                  query_name: str = "bronze") -> StreamingQuery:
    """K1: parse raw records (of any source) and write each epoch to the raw table."""
    def run(df: DataFrame, epoch_id: int) -> None:
        bid = f"bronze_{epoch_id}"
        enriched = ingest.enrich_raw(ingest.parse_records(df), bid, source_system)
        n = write_bronze_batch(enriched, bid, path, writers)
        _count_row(df.sparkSession, metrics_path, bid, {"stage": "bronze", "rows_written": n})

    w = (records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .queryName(query_name))
    return _with_trigger(w, trigger).start()


# ------------------------------------------------------------------ 2. clean

def clean_batch(df: DataFrame, epoch_id: int, log_path: str, dlq_path: str,
                metrics_path: str | None = None, generation: int = 0,
                writers: int = WRITERS, writer: str = "stream", current_path: str | None = None,
                buckets: int = current_table.BUCKETS) -> dict:
    """K3 body: one micro-batch → log partition + DLQ partition + metrics row.

    Re-running the same ``epoch_id`` of the same ``writer`` rewrites the same
    directories, so the result is the same (exactly-once in effect). Rows
    carry the ``generation`` given by the caller, so after a rollback they
    win over the restated rows.

    After the cleaning work the rows are dealt to ``writers`` tasks a date.
    All counters are exact: input and dead letters are observed on the split,
    clean rows on the write; duplicates follow from them.

    With ``current_path`` the batch, as stored, is also folded into the bucketed
    current table (``operators.current_table``); only the buckets of its keys are touched.
    """
    spark = df.sparkSession
    o_in, o_out = Observation(f"in_{epoch_id}"), Observation(f"out_{epoch_id}")
    good, bad = ingest.split_dead_letters(df, o_in)
    clean = refine.refine(good, keep_order=True).observe(o_out, F.count(F.lit(1)).alias("n"))
    logged = changelog.as_log(clean, epoch_id, F.current_timestamp().cast("timestamp_ntz"), generation)
    salt = F.pmod(F.xxhash64("event_id"), F.lit(writers))
    changelog.write_batch(logged.repartition("event_date", salt), log_path, epoch_id, writer)
    if current_path:
        stored = changelog.read_batch(spark, log_path, epoch_id, writer, log_schema(spark))
        current_table.upsert(stored, current_path, buckets=buckets)
    dead = ingest.to_dead_letter(bad)
    dead.write.mode("overwrite").parquet(f"{dlq_path}/writer={writer}/batch_id={int(epoch_id)}")
    seen, n_out = o_in.get, int(o_out.get["n"])
    m = {
        "batch_id": int(epoch_id),
        "rows_in": int(seen["rows_in"]),
        "rows_dead_letter": int(seen["rows_dead_letter"]),
        "rows_clean": n_out,
        "duplicates_removed": int(seen["rows_in"]) - int(seen["rows_dead_letter"]) - n_out,
    }
    _count_row(spark, metrics_path, f"{writer}_{epoch_id}", {"stage": "clean"} | {k: v for k, v in m.items() if k != "batch_id"})
    return m


def backfill_clean(spark: SparkSession, bronze_path: str, log_path: str, dlq_path: str,
                   batch_id: int, start_date: str | None = None, end_date: str | None = None,
                   metrics_path: str | None = None, generation: int = 0) -> dict:
    """T11 batch backfill: bronze rows of a date range through the same
    ``clean_batch`` the stream runs, written as batch ``batch_id`` of the writer ``backfill``.

    The date bounds are bare comparisons on the ``event_date`` directories,
    so only those partitions are listed and read. Returns the batch metrics
    (``rows_clean`` is the reference's returned count).
    """
    bronze = ingest.date_range(spark.read.schema(bronze_schema(spark)).parquet(bronze_path),
                               start_date, end_date)
    return clean_batch(bronze, batch_id, log_path, dlq_path, metrics_path, generation, writer="backfill")


def clean_stream(spark: SparkSession, bronze_path: str, log_path: str, dlq_path: str,
                 checkpoint: str, metrics_path: str | None = None, trigger: dict | None = None,
                 max_files_per_trigger: int | None = None, generation: int = 0,
                 query_name: str = "clean", current_path: str | None = None) -> StreamingQuery:
    """K3 + S4: stream the bronze table into the clean change log (and, with ``current_path``, the current table).

    ``generation`` is what ``changelog.write_rollback`` returned, if the log
    was ever rolled back.

    A retried bronze epoch overwrites its directory; files listed before the
    retry may then be gone, so missing files are skipped (the rewritten ones
    arrive as new files; duplicates resolve by latest-per-key).
    """
    reader = spark.readStream.schema(bronze_schema(spark)).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    src = reader.parquet(bronze_path)

    def run(df: DataFrame, epoch_id: int) -> None:
        clean_batch(df, epoch_id, log_path, dlq_path, metrics_path, generation, current_path=current_path)

    w = (src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .queryName(query_name))
    return _with_trigger(w, trigger).start()


# ------------------------------------------------------------------ 3. KPIs

def kpi_frame(events: DataFrame, watermark: str = WATERMARK, length: str = "5 minutes",
              slide: str = "1 minute", exact: bool = True) -> DataFrame:
    """A5 as a streaming plan (T2, T3). ``exact=False`` uses one HLL aggregate.

    Re-delivered events (same ``event_id``) are counted once, within the
    watermark: the log holds every delivery, the batch KPIs the latest one.
    """
    # watermarks need TIMESTAMP; event time is UTC wall clock (NTZ) in the tables
    ev = (events.withColumn("_event_time", F.col("event_timestamp").cast("timestamp"))
          .withWatermark("_event_time", watermark)
          .dropDuplicatesWithinWatermark(["event_id"]))
    return kpi_levels(ev, length, slide, exact)


def kpi_levels(ev: DataFrame, length: str = "5 minutes", slide: str = "1 minute", exact: bool = True) -> DataFrame:
    """The aggregation levels of ``kpi_frame`` over rows with ``_event_time``, stream or batch."""
    win = F.window("_event_time", length, slide).alias("window")
    purchase_amt = F.when(F.col("event_type") == "purchase", F.col("total_amount")).otherwise(F.lit(0))
    if exact:
        per_user = ev.groupBy(win, "event_type", "user_id").agg(
            F.count("event_id").alias("n"), F.sum(purchase_amt).alias("rev"))
        agg = per_user.groupBy("window", "event_type").agg(
            F.sum("n").alias("event_count"),
            F.count("user_id").alias("active_users"),
            F.sum("rev").cast("double").alias("window_revenue"))
    else:
        agg = ev.groupBy(win, "event_type").agg(
            F.count("event_id").alias("event_count"),
            F.approx_count_distinct("user_id").alias("active_users"),
            F.sum(purchase_amt).cast("double").alias("window_revenue"))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                      "event_type", "event_count", "active_users", "window_revenue")


def kpi_stream(spark: SparkSession, log_path: str, path: str, checkpoint: str,
               trigger: dict | None = None, exact: bool = True, output_mode: str = "append",
               query_name: str = "kpis") -> StreamingQuery:
    """K7: KPI rows from the change log.

    ``append``: a window's row is written once, when the watermark passes
    its end. ``update``: every trigger writes the windows it changed to
    ``path/epoch=<n>`` (overwriting that directory, so retries are
    idempotent); ``kpi_current`` reads the latest row per window. Spark
    allows several stateful operators only in append mode, so ``update``
    counts users with one HLL aggregate (``exact=False``).
    """
    src = (spark.readStream.schema(log_schema(spark)).option("ignoreMissingFiles", "true")
           .parquet(log_path))   # a retried clean epoch rewrites its directory
    live = src.filter(~F.col("is_deleted"))
    if output_mode == "append":
        w = (kpi_frame(live, exact=exact).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).queryName(query_name))
        return _with_trigger(w, trigger or KPI_TRIGGER).start(path)
    if output_mode != "update":
        raise ValueError(f"output_mode must be append or update, got {output_mode}")
    if exact:
        raise ValueError("update mode allows one stateful aggregate: use exact=False")

    def write(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    w = (kpi_frame(live, exact=False).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).queryName(query_name))
    return _with_trigger(w, trigger or KPI_TRIGGER).start()


def kpi_current(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per (window, event type) across the update-mode epochs."""
    rows = spark.read.parquet(path)
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in ("window_start", "event_type")]),
                    F.col("epoch")).alias("_b")
    return (rows.groupBy("window_start", "event_type").agg(best)
            .select("window_start", "event_type", "_b.*").drop("epoch"))


# ------------------------------------------------------------------ T8, T9

def start_streams(spark: SparkSession, records: DataFrame | str, root: str,
                  checkpoint_root: str | None = None,
                  trigger: dict | None = None, records_format: str = "parquet",
                  max_files_per_trigger: int | None = 500, generation: int = 0,
                  max_records_per_trigger: int | None = None) -> list[StreamingQuery]:
    """The three chained queries. The caller waits with
    ``spark.streams.awaitAnyTermination()`` and stops with ``q.stop()`` (D19).

    ``records`` is a stream of raw records (``ingest.kafka_stream``, say) or a
    folder of them. File sources limit a trigger by files, also the clean
    stream's; a Kafka source limits it by records (``kafka_options``), and so does
    a Parquet folder with ``max_records_per_trigger`` (``record_source``).
    The clean stream also keeps the bucketed current table at ``root/current``.
    Checkpoints default to the cluster's shared ``spark.checkpoint.dir``.
    """
    from tidepool.operators import schemas
    from tidepool.session import checkpoint_dir
    if checkpoint_root is None:
        checkpoint_root = f"{checkpoint_dir(spark).rstrip('/')}/tidepool-streams"
    configure_streaming(spark)
    bronze = f"{root}/bronze"
    schemas.initialize_table(spark, bronze, bronze_schema(spark), ["batch_id", *BRONZE_PARTITIONS])
    if isinstance(records, str):
        records = (record_source.stored_record_stream(spark, records, max_records_per_trigger) if max_records_per_trigger
                   else ingest.file_record_stream(spark, records, records_format, max_files_per_trigger))
    q1 = bronze_stream(records, bronze, f"{checkpoint_root}/bronze", trigger, metrics_path=f"{root}/run_metrics")
    q2 = clean_stream(spark, bronze, f"{root}/clean_log", f"{root}/dead_letter",
                      f"{checkpoint_root}/clean", f"{root}/run_metrics", trigger, max_files_per_trigger, generation,
                      current_path=f"{root}/current")
    schemas.initialize_table(spark, f"{root}/clean_log", log_schema(spark), ["writer", "batch_id", *changelog.PARTITION_BY])
    q3 = kpi_stream(spark, f"{root}/clean_log", f"{root}/kpis", f"{checkpoint_root}/kpis", trigger)
    return [q1, q2, q3]


PROGRESS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("run_id", T.StringType()), T.StructField("is_active", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("batch_id", T.LongType()), T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()),
    T.StructField("trigger_ms", T.LongType()), T.StructField("watermark", T.StringType()),
    T.StructField("state_rows", T.LongType()), T.StructField("late_rows_dropped", T.LongType()),
])


def _progress_row(name, ident, run_id, active: bool, status, p: dict) -> tuple:
    ops = p.get("stateOperators", [])
    return (name, ident, run_id, active, status, int(p.get("batchId", -1)), int(p.get("numInputRows", 0)),
            float(p.get("inputRowsPerSecond", 0.0) or 0.0), float(p.get("processedRowsPerSecond", 0.0) or 0.0),
            int(p.get("durationMs", {}).get("triggerExecution", 0)), p.get("eventTime", {}).get("watermark"),
            sum(int(o.get("numRowsTotal", 0)) for o in ops), sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in ops))


class ProgressLog(StreamingQueryListener):
    """Appends every progress report of every query to a table.

    A query itself remembers only its last hundred reports; the table keeps
    all, so late rows (``late_rows_dropped``) add up over the whole run. Reports are written ``every`` so many,
    and when a query ends, so that the listener seldom starts a job. Add it
    with ``spark.streams.addListener(ProgressLog(spark, path))``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []

    def flush(self) -> None:
        """Writes the reports held so far."""
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        self.held.append(_progress_row(p.get("name"), p["id"], p["runId"], True, "progress", p))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()


def progress_frame(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """Status and the reports each query still remembers, as rows (``ProgressLog`` keeps all).

    ``late_rows_dropped`` sums the state operators' rows dropped by the
    watermark (T4).
    """
    rows = [_progress_row(q.name, str(q.id), str(q.runId), bool(q.isActive), (q.status or {}).get("message"), json.loads(p.json) if hasattr(p, "json") else p)
            for q in queries for p in q.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
