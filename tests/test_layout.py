"""Layout jobs and table metadata."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import changelog, layout, marts, schemas
from tidepool.plans import catalog
from tidepool.streaming import streams


def _bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_initialize_table_creates_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    schemas.initialize_table(spark, path, schemas.SILVER_SCHEMA, schemas.SILVER_PARTITIONS)
    # typed tables are read with their declared schema (an empty Parquet
    # directory carries none)
    t = spark.read.schema(schemas.SILVER_SCHEMA).parquet(path)
    assert t.count() == 0 and t.columns == schemas.SILVER_SCHEMA.fieldNames()
    spark.range(3).write.mode("overwrite").parquet(str(tmp_path / "x"))
    schemas.initialize_table(spark, path, schemas.SILVER_SCHEMA, schemas.SILVER_PARTITIONS)  # no-op


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    src, out = str(tmp_path / "bronze"), str(tmp_path / "compact")
    bronze = catalog.bronze(spark, SF_SMALL).drop("ingestion_timestamp")
    bronze.repartition(16).write.partitionBy("event_date").parquet(src)
    before = layout.table_details(spark, src, ["event_date"]).first()
    after = layout.optimize(spark, src, out, partition_cols=["event_date"]).first()
    assert after["row_count"] == before["row_count"]
    assert after["num_files"] < before["num_files"]
    assert _bag(spark.read.parquet(out)) == _bag(spark.read.parquet(src))


def test_partition_filtered_optimize_in_place(spark, tmp_path):
    src = str(tmp_path / "t")
    bronze = catalog.bronze(spark, SF_SMALL).drop("ingestion_timestamp")
    bronze.repartition(6).write.partitionBy("event_date").parquet(src)
    rows = _bag(spark.read.parquet(src))
    files = {r[0] for r in spark.read.parquet(src).select("_metadata.file_path").distinct().collect()}
    details = layout.optimize_in_place(spark, src, str(tmp_path / "staged"), where="event_date >= '2024-01-20'").first()
    spark.catalog.refreshByPath(src)
    assert _bag(spark.read.parquet(src)) == rows and details["partitioning"] == ["event_date"]
    now = {r[0] for r in spark.read.parquet(src).select("_metadata.file_path").distinct().collect()}
    early = {f for f in files if f.split("event_date=")[1][:10] < "2024-01-20"}
    assert early <= now and len(now) < len(files)            # other partitions keep their files


def test_zorder_clusters_for_skipping(spark, tmp_path):
    base, z = str(tmp_path / "plain"), str(tmp_path / "z")
    clean = catalog.clean(spark, SF_SMALL, keep_order=False).drop("silver_processed_at")
    clean.repartition(8).write.parquet(base)
    layout.optimize(spark, base, z, zorder_columns=["event_date", "user_id"], num_files=8)
    plain_t, z_t = spark.read.parquet(base), spark.read.parquet(z)
    assert _bag(plain_t) == _bag(z_t)                      # same rows

    def files_touched(t, cond):
        # files holding any matching row: a lower bound for min/max skipping
        return t.filter(cond).select("_metadata.file_path").distinct().count()

    for cond in [F.col("event_date") == "2024-01-10", F.col("user_id") == "user_7"]:
        assert files_touched(z_t, cond) < files_touched(plain_t, cond)


def test_optimize_all_reports_each_table(spark, tmp_path):
    ok = str(tmp_path / "ok")
    spark.range(100).write.parquet(ok)
    res = {r["table"]: r for r in layout.optimize_all(
        spark, {"ok": ok, "missing": str(tmp_path / "nope")}, str(tmp_path / "out"),
        zorder_config={"ok": ["id"]}).collect()}
    assert res["ok"]["status"] == "optimized" and res["ok"]["row_count"] == 100
    assert res["missing"]["status"] == "absent"


def test_optimize_all_keeps_the_partitioning(spark, tmp_path):
    src, out = str(tmp_path / "t"), str(tmp_path / "out")
    spark.range(60).selectExpr("id", "id % 3 AS d", "id % 2 AS h").write.partitionBy("d", "h").parquet(src)
    layout.optimize_all(spark, {"silver": src}, out, zorder_config={"silver": ["id"]})
    assert layout.partitioning(spark, f"{out}/silver") == ["d", "h"]
    assert spark.read.parquet(f"{out}/silver").count() == 60


def test_table_details(spark, tmp_path):
    p = str(tmp_path / "d")
    spark.range(50).withColumn("d", F.lit("x")).repartition(3).write.partitionBy("d").parquet(p)
    d = layout.table_details(spark, p, ["d"]).first()
    assert d["row_count"] == 50 and d["num_files"] == 3 and d["partitioning"] == ["d"]
    assert d["column_count"] == 2 and d["size_bytes"] > 0


def test_replace_only_present_dates(spark):
    clean = catalog.clean(spark, SF_SMALL)
    old = marts.product_mart(clean)
    new = old.filter(F.col("event_date") == "2024-01-05").withColumn("views", F.lit(-1).cast("long"))
    got = changelog.replace_from_min(old, new, only_present=True)
    assert got.count() == old.count()
    assert got.filter(F.col("views") == -1).count() == new.count()
    # default keeps the reference meaning: every later date is replaced too
    assert changelog.replace_from_min(old, new).filter(F.col("event_date") > "2024-01-05").count() == 0


def test_zorder_splits_a_hot_key(spark, tmp_path):
    # a third of the rows share one value in both clustering columns
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS a",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS b")
    out = layout.zorder(df, ["a", "b"], num_files=6)
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) <= 2 * 3000 / 6 and sum(sizes) == 3000


def _stored(spark, path):
    return changelog.read_log(spark, path, streams.log_schema(spark))


def _live(df):
    d = df.drop("silver_processed_at")
    return _bag(d.select(*sorted(d.columns)))       # partition columns come back last


def test_change_log_on_disk_rollback_chain(spark, tmp_path):
    path = str(tmp_path / "log")
    log = catalog.change_log(spark, SF_SMALL)
    for bid in range(30):
        changelog.write_batch(log.filter(F.col("batch_id") == bid), path, bid)
    assert _live(changelog.current(_stored(spark, path))) == _live(changelog.current(log))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    schema = streams.log_schema(spark)
    generations = [changelog.write_rollback(spark, path, v, schema, committed_at=at) for v in (14, 5)]
    assert generations == [1, 2]
    stored = _stored(spark, path)
    assert _live(changelog.current(stored)) == _live(changelog.as_of_version(log, 5))
    # only keys that changed after the version are written again
    changed = log.filter("batch_id > 14").select("event_id").distinct().count()
    assert stored.filter("writer = 'rollback' and generation = 1").count() == changed
    h = changelog.history(stored, 3).collect()
    assert [r["batch_id"] for r in h] == [31, 30, 29] and h[0]["operation"] == "ROLLBACK"
    before = stored.count()
    changelog.write_batch(log.filter(F.col("batch_id") == 3), path, 3)      # a retried batch
    assert _stored(spark, path).count() == before


def test_log_filters_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    log = catalog.change_log(spark, SF_SMALL)
    for bid in (0, 1, 2):
        changelog.write_batch(log.filter(F.col("batch_id") == bid), path, bid)
    q = _stored(spark, path).filter(F.col("event_date") == "2024-01-02")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1][:200]
    assert q.count() == log.filter(F.col("event_date") == "2024-01-02").filter("batch_id <= 2").count()
    ts = log.filter("batch_id = 1").agg(F.max("committed_at").cast("string")).first()[0]
    stored = _stored(spark, path)
    by_time = changelog.as_of_time_batches(stored, changelog.history(log, 100), ts)
    assert _live(by_time) == _live(changelog.as_of_timestamp(stored, ts))


def _writers(spark, path):
    """Three writers that number their batches apart: the stream at 9, 10 and 13 o'clock, a backfill at 12, rollbacks later."""
    log = catalog.change_log(spark, SF_SMALL)

    def put(rows, n, hour, writer):
        at = F.lit(f"2024-03-01 {hour:02d}:00:00").cast("timestamp_ntz")
        changelog.write_batch(rows.withColumn("committed_at", at), path, n, writer)
    put(log.filter("batch_id = 0"), 1, 9, "stream")
    put(log.filter("batch_id = 1"), 2, 10, "stream")
    put(log.filter("batch_id between 2 and 4").withColumn("total_amount", F.lit(1).cast("decimal(29,2)")), 0, 12, "backfill")
    put(log.filter("batch_id between 0 and 5"), 3, 13, "stream")
    return log


def test_versions_of_three_writers_are_one_order(spark, tmp_path):
    path = str(tmp_path / "log")
    _writers(spark, path)
    schema = streams.log_schema(spark)
    at = F.lit("2024-03-01 14:00:00").cast("timestamp_ntz")
    before = _stored(spark, path)
    want = [(0, "stream", 1), (1, "stream", 2), (2, "backfill", 0), (3, "stream", 3)]
    assert sorted((r["version"], r["writer"], r["batch_id"]) for r in changelog.commits(before).collect()) == want
    parts = {v: before.filter((F.col("writer") == w) & (F.col("batch_id") == b)) for v, w, b in want}
    states = []
    for v in range(4):
        upto = parts[0]
        for u in range(1, v + 1):
            upto = upto.unionByName(parts[u])
        states.append(_live(changelog.current(upto)))
        assert _live(changelog.as_of_version(before, v)) == states[v]
    assert len({str(s) for s in states}) == 4
    # rollback to a version in the middle, of two writers; then back over the rollback itself
    assert changelog.write_rollback(spark, path, 1, schema, committed_at=at) == 1
    stored = _stored(spark, path)
    assert _live(changelog.current(stored)) == states[1]
    newest = changelog.history(stored, 2).collect()
    assert [(r["version"], r["writer"], r["operation"]) for r in newest] == [(4, "rollback", "ROLLBACK"), (3, "stream", "MERGE")]
    assert changelog.write_rollback(spark, path, 3, schema, committed_at=F.lit("2024-03-01 15:00:00").cast("timestamp_ntz")) == 2
    stored = _stored(spark, path)
    assert _live(changelog.current(stored)) == states[3]
    assert [_live(changelog.as_of_version(stored, v)) for v in range(6)] == [*states, states[1], states[3]]
    # by time, with the directories pruned by each writer's own numbers
    known = changelog.commits(stored)
    for hour, state in ((8, []), (9, states[0]), (11, states[1]), (12, states[2]), (14, states[1]), (23, states[3])):
        ts = f"2024-03-01 {hour:02d}:30:00"
        got = changelog.as_of_time_batches(stored, known, ts)
        assert _live(got) == _live(changelog.as_of_timestamp(stored, ts)) == state
    plan = changelog.as_of_time_batches(stored, known, "2024-03-01 09:30:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "writer" in plan.split("PartitionFilters: [")[1][:300]
    assert _live(changelog.as_of_version(stored, 99)) == states[3] and changelog.as_of_version(stored, -1).count() == 0


def test_rollback_buries_and_raises_the_dead(spark):
    base = catalog.change_log(spark, SF_SMALL)
    one = base.filter("batch_id = 0").limit(3).collect()
    rows = []
    for i, (r, steps) in enumerate(zip(one, [[(0, False), (1, True)], [(0, True), (1, False)], [(1, False), (2, True)]], strict=True)):
        for b, dead in steps:
            d = r.asDict() | {"event_id": f"k{i}", "batch_id": b, "is_deleted": dead, "kafka_offset": b}
            rows.append(d)
    log = spark.createDataFrame(rows, base.schema)
    assert {r["event_id"] for r in changelog.current(log).collect()} == {"k1"}
    back = changelog.rollback(log, 0)
    assert {r["event_id"] for r in changelog.current(back).collect()} == {"k0"} == {r["event_id"] for r in changelog.as_of_version(log, 0).collect()}
    assert {(r["event_id"], r["is_deleted"]) for r in changelog.rollback_batch(log, 0).collect()} == {("k0", False), ("k1", True)}
