"""Streams on the file source with availableNow triggers."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import changelog, marts, refine
from tidepool.plans import catalog
from tidepool.sources import fixtures as FX
from tidepool.sources import ingest
from tidepool.streaming import streams as P

ONCE = {"availableNow": True}


def _run(q):
    assert q.awaitTermination(600), "stream did not finish"
    assert q.exception() is None, q.exception()
    return q


def _log(spark, path):
    return changelog.read_log(spark, path, P.log_schema(spark))


def test_streams_end_to_end(spark, tmp_path):
    root, ck = str(tmp_path / "lake"), str(tmp_path / "ck")
    records = str(tmp_path / "records")
    FX.raw_json(spark, SF_SMALL).repartition(4, "offset").write.parquet(records)
    recs = ingest.file_record_stream(spark, records, max_files_per_trigger=1)
    _run(P.bronze_stream(recs, f"{root}/bronze", f"{ck}/bronze", ONCE))
    raw = FX.raw_events(spark, SF_SMALL)
    bronze = spark.read.parquet(f"{root}/bronze")
    assert bronze.count() == raw.count()
    assert bronze.select("batch_id").distinct().count() == 4      # one directory per epoch
    n_parts = bronze.select("batch_id", "event_date", "event_hour").distinct().count()
    assert n_parts <= bronze.select("_metadata.file_path").distinct().count() <= P.WRITERS * n_parts

    n_files = bronze.select("_metadata.file_path").distinct().count()
    q2 = _run(P.clean_stream(spark, f"{root}/bronze", f"{root}/log", f"{root}/dlq", f"{ck}/clean",
                             f"{root}/metrics", ONCE, max_files_per_trigger=n_files // 3 + 1))
    log = _log(spark, f"{root}/log")
    assert log.select("batch_id").distinct().count() >= 2          # several epochs
    live = changelog.current(log)
    n_bad = raw.filter(F.col("kafka_offset") % FX.MALFORMED_EVERY == 0).count()
    # the log's current state equals the batch clean step over the deliveries
    # that were not dead-lettered; the latest delivery wins across epochs
    cols = [c for c in refine.SILVER_COLUMNS if c not in ("silver_processed_at", "bronze_batch_id")]
    good = catalog.bronze(spark, SF_SMALL).filter(F.col("kafka_offset") % FX.MALFORMED_EVERY != 0)
    expect = refine.refine(good).select(*cols)
    assert live.select(*cols).exceptAll(expect).count() == 0
    assert expect.exceptAll(live.select(*cols)).count() == 0
    assert spark.read.parquet(f"{root}/dlq").count() == n_bad
    m = spark.read.parquet(f"{root}/metrics").filter("stage = 'clean'").agg(
        F.sum("rows_in").alias("i"), F.sum("rows_dead_letter").alias("d")).first()
    assert m["i"] == raw.count() and m["d"] == n_bad

    _run(P.kpi_stream(spark, f"{root}/log", f"{root}/kpis", f"{ck}/kpis", ONCE))
    got = spark.read.parquet(f"{root}/kpis")
    assert got.count() > 0
    # every emitted window equals the batch result on the same events
    first_delivery = log.groupBy("event_id").agg(F.min_by(F.struct("*"), F.struct("kafka_timestamp",
                                                 "kafka_offset")).alias("r")).select("r.*")
    want = marts.kpi_windows(first_delivery)
    cols = ["window_start", "window_end", "event_type", "event_count", "active_users"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    # a re-delivered event has another price, and the stream keeps either delivery: revenue lies between the two
    last = marts.kpi_windows(live)
    key = ["window_start", "event_type"]
    both = (got.join(want.select(*key, F.col("window_revenue").alias("a")), key)
            .join(last.select(*key, F.col("window_revenue").alias("b")), key))
    outside = ~F.col("window_revenue").between(F.least("a", "b") - 0.001, F.greatest("a", "b") + 0.001)
    assert both.count() == got.count() and both.filter(outside).count() == 0
    # and every window that closed (the watermark passed its end) is there
    closed = want.filter(F.col("window_end") <= got.agg(F.max("window_end")).first()[0])
    assert closed.select(*cols).exceptAll(got.select(*cols)).count() == 0
    prog = P.progress_frame(spark, [q2])
    # each batch reads its files twice, for the log and for the dead letters
    assert prog.count() >= 2 and prog.agg(F.sum("num_input_rows")).first()[0] == 2 * raw.count()


def test_clean_batch_is_idempotent(spark, tmp_path):
    recs = FX.raw_json(spark, SF_SMALL)
    df = ingest.enrich_raw(ingest.parse_records(recs), "b1")
    out = {k: str(tmp_path / k) for k in ("log", "dlq", "m")}
    m1 = P.clean_batch(df, 7, out["log"], out["dlq"], out["m"])
    first = spark.read.parquet(out["log"]).drop("committed_at", "silver_processed_at").collect()
    m2 = P.clean_batch(df, 7, out["log"], out["dlq"], out["m"])   # retried epoch
    again = spark.read.parquet(out["log"]).drop("committed_at", "silver_processed_at").collect()
    assert m1 == m2 and sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    assert m1["duplicates_removed"] > 0


def _events(spark, rows):
    schema = P.log_schema(spark)
    base = {f.name: None for f in schema.fields}
    data = []
    for i, (ts, user, et) in enumerate(rows):
        r = dict(base, event_id=f"e{ts.isoformat()}{i}", event_type=et, user_id=user,
                 event_timestamp=ts, kafka_timestamp=ts, kafka_offset=i, is_deleted=False,
                 generation=0, batch_id=0)
        data.append(r)
    return spark.createDataFrame(data, schema)


def test_kpi_late_rows_dropped_and_restart(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    a = [(t0 + dt.timedelta(minutes=m), f"u{m % 3}", "page_view") for m in range(0, 30)]
    _events(spark, a).write.mode("append").parquet(f"{src}/batch_id=0")
    _run(P.kpi_stream(spark, src, out, ck, ONCE))
    n1 = spark.read.parquet(out).count()
    # second delivery, after a restart from the same checkpoint: one row far
    # behind the watermark (late), the rest new
    b = [(t0 - dt.timedelta(minutes=30), "late", "page_view")] + \
        [(t0 + dt.timedelta(minutes=m), "u9", "purchase") for m in range(40, 60)]
    _events(spark, b).write.mode("append").parquet(f"{src}/batch_id=1")
    q = _run(P.kpi_stream(spark, src, out, ck, ONCE))
    got = spark.read.parquet(out)
    assert got.count() > n1
    late = got.filter(F.col("window_end") <= F.lit(t0 - dt.timedelta(minutes=20)))
    assert late.count() == 0                  # the late row opened no window
    dropped = P.progress_frame(spark, [q]).agg(F.sum("late_rows_dropped")).first()[0]
    assert dropped >= 1
    # no window is emitted twice across the restart
    assert got.groupBy("window_start", "event_type").count().filter("count > 1").count() == 0


def test_kpi_update_mode_converges_to_batch(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    a = [(t0 + dt.timedelta(minutes=m), f"u{m % 4}", "page_view") for m in range(0, 20)]
    b = [(t0 + dt.timedelta(minutes=m), f"u{m % 5}", "page_view") for m in range(10, 30)]
    _events(spark, a).write.parquet(f"{src}/batch_id=0")
    _run(P.kpi_stream(spark, src, out, ck, ONCE, exact=False, output_mode="update"))
    _events(spark, b).write.parquet(f"{src}/batch_id=1")
    _run(P.kpi_stream(spark, src, out, ck, ONCE, exact=False, output_mode="update"))
    got = P.kpi_current(spark, out)
    want = marts.kpi_windows(_events(spark, a + b))
    cols = ["window_start", "event_type", "event_count", "active_users"]
    # small cardinalities: HLL is exact here
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_start_streams_runs_three_chained_queries(spark, tmp_path):
    records, root, ck = str(tmp_path / "rec"), str(tmp_path / "lake"), str(tmp_path / "ck")
    FX.raw_json(spark, SF_SMALL).repartition(2).write.parquet(records)
    # availableNow: each run handles what its input holds when it starts, so
    # the chain settles over repeated runs, restarting from the checkpoints
    for _ in range(3):
        for q in P.start_streams(spark, records, root, ck, trigger=ONCE, max_files_per_trigger=None):
            _run(q)
    live = changelog.current(_log(spark, f"{root}/clean_log"))
    good = catalog.bronze(spark, SF_SMALL).filter(F.col("kafka_offset") % FX.MALFORMED_EVERY != 0)
    assert live.count() == refine.refine(good).count()
    assert spark.read.parquet(f"{root}/kpis").count() > 0
    assert spark.read.parquet(f"{root}/dead_letter").count() > 0


def test_bronze_batch_spreads_an_hour(spark, tmp_path):
    recs = FX.raw_json(spark, SF_SMALL)
    enriched = ingest.enrich_raw(ingest.parse_records(recs), "b7")
    path = str(tmp_path / "bronze")
    # in a batch context AQE would merge these tiny shuffle partitions (streams run without AQE)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        n = P.write_bronze_batch(enriched, "b7", path, writers=4)
    finally:
        spark.conf.set(key, "true")
    t = spark.read.parquet(path)
    assert n == t.count() == recs.count()
    per_hour = t.groupBy("event_date", "event_hour").agg(
        F.countDistinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("rows"))
    busiest = per_hour.orderBy(F.desc("rows")).first()
    assert 1 < busiest["files"] <= 4
    again = P.write_bronze_batch(enriched, "b7", path, writers=4)   # retried batch
    assert again == n and spark.read.parquet(path).count() == n


def test_a_rollback_survives_the_resumed_stream(spark, tmp_path):
    """Two epochs, a rollback, one more epoch and a backfill: live = as of the version plus the new rows."""
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    raw = ingest.enrich_raw(ingest.parse_records(FX.raw_json(spark, SF_SMALL)), "b").filter("_corrupt is null").persist()
    first = raw.filter(F.col("kafka_offset") < 400)
    second = raw.filter((F.col("kafka_offset") >= 400) & (F.col("kafka_offset") < FX.DUP_OFFSET_SHIFT))
    third = raw.filter((F.col("kafka_offset") >= FX.DUP_OFFSET_SHIFT) & (F.col("kafka_offset") < FX.DUP_OFFSET_SHIFT + 200))

    def epoch(part, name, generation=0):
        P.write_bronze_batch(part, name, bronze)
        _run(P.clean_stream(spark, bronze, log, str(tmp_path / "dlq"), str(tmp_path / "ck"), trigger=ONCE, generation=generation))

    def state(df):
        return sorted((r["event_id"], r["kafka_offset"]) for r in df.select("event_id", "kafka_offset").collect())

    epoch(first, "bronze_0")
    epoch(second, "bronze_1")
    as_of = changelog.as_of_version(_log(spark, log), 0)
    then = state(as_of)
    generation = changelog.write_rollback(spark, log, 0, P.log_schema(spark))
    assert state(changelog.current(_log(spark, log))) == then != state(raw.dropDuplicates(["event_id"]))
    epoch(third, "bronze_2", generation)
    P.backfill_clean(spark, bronze, log, str(tmp_path / "dlq"), 0, "2024-01-01", "2024-01-01", generation=generation)
    stored = _log(spark, log)
    assert {(r["writer"], r["batch_id"]) for r in stored.select("writer", "batch_id").distinct().collect()} == {
        ("stream", 0), ("stream", 1), ("stream", 2), ("rollback", 2), ("backfill", 0)}       # nothing is overwritten
    filled = state(refine.dedup_latest(spark.read.schema(P.bronze_schema(spark)).parquet(bronze).filter("event_date = '2024-01-01'")))
    want = dict(then)
    for more in (state(third), filled):
        want.update({k: max(v, want.get(k, v)) for k, v in more})
    assert state(changelog.current(stored)) == sorted(want.items())
    raw.unpersist()


def test_raw_record_stream_with_headers_feeds_all_queries(spark, tmp_path):
    """The Kafka route: raw records (headers included) in, parsed once."""
    records, root = str(tmp_path / "rec"), str(tmp_path / "lake")
    raw = FX.raw_json(spark, SF_SMALL).withColumn("headers", F.array(F.struct(F.lit("trace").alias("key"), F.lit(b"1").alias("value"))))
    raw.write.parquet(records)
    for _ in range(3):
        source = spark.readStream.schema(raw.schema).parquet(records)
        for q in P.start_streams(spark, source, root, str(tmp_path / "ck"), trigger=ONCE, max_files_per_trigger=None):
            _run(q)
    bronze = spark.read.parquet(f"{root}/bronze")
    assert bronze.count() == raw.count() and bronze.select(F.col("kafka_headers")[0]["key"]).first()[0] == "trace"
    assert changelog.current(_log(spark, f"{root}/clean_log")).count() > 0 and spark.read.parquet(f"{root}/kpis").count() > 0
    stages = {r[0] for r in spark.read.option("mergeSchema", "true").parquet(f"{root}/run_metrics").select("stage").distinct().collect()}
    assert stages == {"bronze", "clean"}


def test_progress_log_keeps_every_report(spark, tmp_path):
    records, out = str(tmp_path / "rec"), str(tmp_path / "progress")
    FX.raw_json(spark, SF_SMALL).repartition(3).write.parquet(records)
    listener = P.ProgressLog(spark, out)
    spark.streams.addListener(listener)
    try:
        _run(P.bronze_stream(ingest.file_record_stream(spark, records, max_files_per_trigger=1), str(tmp_path / "b"), str(tmp_path / "ck"), ONCE))
        for _ in range(60):
            if os.path.exists(out) and spark.read.schema(P.PROGRESS_SCHEMA).parquet(out).count() >= 3:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.schema(P.PROGRESS_SCHEMA).parquet(out)
    assert got.agg(F.sum("num_input_rows")).first()[0] == FX.raw_json(spark, SF_SMALL).count()


def test_backfill_a_date_range(spark, tmp_path):
    recs = FX.raw_json(spark, SF_SMALL)
    bronze = str(tmp_path / "bronze")
    P.write_bronze_batch(ingest.enrich_raw(ingest.parse_records(recs), "b0"), "b0", bronze)
    log = str(tmp_path / "log")
    m = P.backfill_clean(spark, bronze, log, str(tmp_path / "dlq"), 0, "2024-01-05", "2024-01-09")
    got = _log(spark, log)
    dates = {r[0] for r in got.select("event_date").distinct().collect()}
    assert dates == {f"2024-01-0{d}" for d in range(5, 10)} and m["rows_clean"] == got.count()
    # the date bounds reach the scan as partition filters
    plan = spark.read.schema(P.bronze_schema(spark)).parquet(bronze) \
        .filter("event_date >= '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_json_lines_records_stream(spark, tmp_path):
    src, out = str(tmp_path / "json"), str(tmp_path / "bronze")
    FX.raw_json(spark, SF_SMALL).write.json(src)
    recs = ingest.file_record_stream(spark, src, fmt="json")
    _run(P.bronze_stream(recs, out, str(tmp_path / "ck"), ONCE))
    got = spark.read.parquet(out)
    assert got.count() == FX.raw_events(spark, SF_SMALL).count()
    assert got.filter(F.col("_corrupt").isNotNull()).count() == \
        FX.raw_events(spark, SF_SMALL).filter(F.col("kafka_offset") % FX.MALFORMED_EVERY == 0).count()


def test_downstream_survives_a_rewritten_upstream_batch(spark, tmp_path):
    recs = FX.raw_json(spark, SF_SMALL)
    bronze, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    enriched = ingest.enrich_raw(ingest.parse_records(recs), "x")
    P.write_bronze_batch(enriched, "bronze_0", bronze)
    _run(P.clean_stream(spark, bronze, log, str(tmp_path / "dlq"), str(tmp_path / "ck"), trigger=ONCE))
    P.write_bronze_batch(enriched, "bronze_0", bronze)          # the upstream epoch is retried
    _run(P.clean_stream(spark, bronze, log, str(tmp_path / "dlq"), str(tmp_path / "ck"), trigger=ONCE))
    live = changelog.current(_log(spark, log))
    good = catalog.bronze(spark, SF_SMALL).filter(F.col("kafka_offset") % FX.MALFORMED_EVERY != 0)
    assert live.count() == refine.refine(good).count()              # duplicates resolved


def test_readme_usage_flow(spark, tmp_path):
    from tidepool.operators import layout, quality, serve, sinks
    root = str(tmp_path / "lake")
    FX.raw_json(spark, SF_SMALL).write.parquet(f"{root}/records")
    for _ in range(3):                                   # availableNow runs settle the chain
        for q in P.start_streams(spark, f"{root}/records", root, str(tmp_path / "ck"),
                                 trigger=ONCE, max_files_per_trigger=None):
            _run(q)
    clean = changelog.current(_log(spark, f"{root}/clean_log"))
    counts = sinks.write_marts(clean, f"{root}/gold")
    assert all(n > 0 for n in counts.values())
    assert quality.summarize(quality.validate(clean, quality.silver_rules())).first()["total_records"] \
        == clean.count()
    assert serve.revenue_query(clean, "2024-01-01", "2024-03-31", granularity="weekly").count() > 0
    assert changelog.write_rollback(spark, f"{root}/clean_log", 0, P.log_schema(spark)) == 1
    res = layout.optimize_all(spark, {"silver": f"{root}/clean_log"}, f"{root}/optimized").first()
    assert res["status"] == "optimized"
