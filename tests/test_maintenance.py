"""Maintenance with streams on both sides, and the bucketed current table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import ONCE, _log, _run
from tidepool.operators import changelog, current_table, layout
from tidepool.plans import catalog
from tidepool.sources import fixtures as FX
from tidepool.sources import ingest
from tidepool.streaming import streams as P


def _files(spark, path):
    return {r[0]: r[1] for r in spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def _bag(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_compaction_between_streams_cleans_nothing_twice(spark, tmp_path):
    root, ck, copy = str(tmp_path / "lake"), str(tmp_path / "ck"), str(tmp_path / "copy")
    schema = P.bronze_schema(spark).add("batch_id", "string").add("event_date", "string").add("event_hour", "int") if "batch_id" not in P.bronze_schema(spark).names \
        else P.bronze_schema(spark)
    records = FX.raw_json(spark, SF_SMALL)

    def deliver(n):
        records.filter(F.col("offset") % 4 == n).write.mode("append").parquet(f"{root}/records")
        _run(P.bronze_stream(ingest.file_record_stream(spark, f"{root}/records"), f"{root}/bronze", f"{ck}/bronze", ONCE))

    def clean():
        _run(P.clean_stream(spark, f"{root}/bronze", f"{root}/log", f"{root}/dlq", f"{ck}/clean", f"{root}/metrics", ONCE, current_path=f"{root}/current"))
        return _log(spark, f"{root}/log").count()

    def whole():
        return _bag(layout.read_compacted(spark, f"{root}/bronze", copy, schema).drop("ingestion_timestamp"))
    deliver(0)
    deliver(1)
    rows = clean()
    want = whole()
    assert layout.compact_copy(spark, f"{root}/bronze", copy, schema) == [(0, 0)]          # the newest batch waits
    assert layout.compact_copy(spark, f"{root}/bronze", copy, schema, upto=1) == [(0, 0), (1, 1)]
    assert clean() == rows and whole() == want
    deliver(2)
    assert clean() > rows
    want, rows = whole(), _log(spark, f"{root}/log").count()
    assert len(want) == spark.read.parquet(f"{root}/bronze").count()
    # the ranges become one; readers do not read a batch twice
    assert layout.compact_copy(spark, f"{root}/bronze", copy, schema, upto=2, merge_over=2) == [(0, 2)]
    assert whole() == want and clean() == rows
    assert layout.compact_copy(spark, f"{root}/bronze", copy, schema) == [(0, 2)]
    read = layout.read_compacted(spark, f"{root}/bronze", copy, schema)
    assert all(f"{copy}/first=0/last=2" in r[0] for r in read.select(F.input_file_name()).distinct().collect())
    with pytest.raises(ValueError, match="streams read"):
        layout.optimize_in_place(spark, f"{root}/bronze", f"{root}/staging")
    # the current table that the clean stream keeps is the log's
    log = _log(spark, f"{root}/log")
    got = current_table.read(spark, f"{root}/current", P.log_schema(spark))
    live = changelog.current(log).drop("writer")
    assert _bag(got.select(*live.columns)) == _bag(live)


def test_an_upsert_touches_its_buckets_only(spark, tmp_path):
    path, n = str(tmp_path / "t"), 8
    log = catalog.change_log(spark, SF_SMALL).drop("silver_processed_at")
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.schema(log.schema).parquet(str(tmp_path / "log"))
    first, then = log.filter("batch_id < 20"), log.filter("batch_id >= 20")
    current_table.rebuild(first, path, buckets=n)
    assert _bag(current_table.read(spark, path, log.schema, n)) == _bag(changelog.current(first))
    assert len(_files(spark, path)) == n                                                   # a file a bucket
    few = then.orderBy("event_id").limit(2)
    few.write.parquet(str(tmp_path / "few"))
    few = spark.read.schema(log.schema).parquet(str(tmp_path / "few"))
    before = _files(spark, path)
    hit = current_table.upsert(few, path, buckets=n)
    after = _files(spark, path)
    assert 1 <= len(hit) <= 2 and {f for f in before if f not in after} == {f for f in before if any(f"bucket={b}/" in f for b in hit)}
    assert _bag(current_table.read(spark, path, log.schema, n)) == _bag(changelog.current(first.unionByName(few)))
    assert current_table.upsert(few, path, buckets=n) == hit                              # again: the same table
    assert _bag(current_table.read(spark, path, log.schema, n)) == _bag(changelog.current(first.unionByName(few)))
    current_table.upsert(then, path, buckets=n)
    assert _bag(current_table.read(spark, path, log.schema, n)) == _bag(changelog.current(log))
    # an older delivery of a buried key does not bring it back
    key = first.first()["event_id"]
    dead = log.filter(F.col("event_id") == key).withColumns({"is_deleted": F.lit(True), "generation": F.lit(1)})
    current_table.upsert(dead, path, buckets=n)
    current_table.upsert(log.filter(F.col("event_id") == key), path, buckets=n)
    assert current_table.read(spark, path, log.schema, n, keys=[key]).count() == 0
    other = current_table.read(spark, path, log.schema, n, keys=[few.first()["event_id"]])
    assert other.count() == 1 and len(other.inputFiles()) >= 1
    assert "bucket" in other._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1][:80]
    assert current_table.upsert(then.limit(0), path, buckets=n) == []
    current_table.rebuild(log, path, buckets=n, only=[3])
    assert len(_files(spark, path)) == n
    with pytest.raises(ValueError, match="another number of buckets"):
        current_table.upsert(few, path, buckets=n + 1)
