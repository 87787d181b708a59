"""Record limits on stored records, across restarts and new files."""

import datetime as dt

from tests.conftest import SF_SMALL
from tidepool.sources import fixtures as FX
from tidepool.sources import record_source as R
from tidepool.streaming import streams as P

T0 = dt.datetime(2024, 1, 1)


def _put(spark, path, rows, files=1):
    spark.createDataFrame([(f"k{o}", f"v{p}-{o}", "t", p, o, T0) for p, o in rows], R.SCHEMA).coalesce(files).write.mode("append").parquet(path)


def _run(spark, src, out, ck, limit, stop_after=None):
    """Runs until nothing is left (or some batches are done); returns rows of each batch."""
    sizes = []

    def write(df, epoch):
        df.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        sizes.append(df.sparkSession.read.parquet(f"{out}/epoch={epoch}").count())
        if stop_after and len(sizes) == stop_after:
            raise InterruptedError("stop here")
    q = R.stored_record_stream(spark, src, limit).writeStream.foreachBatch(write).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    except Exception as e:
        assert "stop here" in str(e), e
    q.stop()
    return sizes


def test_no_trigger_takes_more_and_none_is_lost(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    # two partitions in one file, gaps, and a far re-delivery; row groups that overlap in a second file
    _put(spark, src, [(0, o) for o in range(0, 130)] + [(1, 3 * o) for o in range(70)] + [(0, 10 ** 9 + o) for o in range(25)])
    _put(spark, src, [(2, o) for o in range(0, 90, 2)])
    _put(spark, src, [(2, o) for o in range(1, 90, 2)])
    first = _run(spark, src, out, ck, 50, stop_after=3)           # fails in its third batch
    assert max(first) <= 50 and len(first) == 3
    _put(spark, src, [(0, 500 + o) for o in range(40)] + [(3, o) for o in range(10)])     # behind the far ones: never read before them
    sizes = _run(spark, src, out, ck, 50)
    assert max(sizes) <= 50
    got = sorted((r["partition"], r["offset"]) for r in spark.read.parquet(out).collect())
    assert len(got) == len(set(got)) == 130 + 70 + 25 + 90 + 40 + 10
    assert _run(spark, src, out, ck, 50) == []                    # nothing new
    _put(spark, src, [(3, 10 + o) for o in range(7)])
    assert _run(spark, src, out, ck, 50) == [7]


def test_a_full_trigger_is_used_and_whole_row_groups_need_no_reading(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    for p in range(3):
        _put(spark, src, [(p, o) for o in range(100)])
    reader = R.StoredRecordsReader(src, 150)
    reads = []
    monkeypatch.setattr(R.StoredRecordsReader, "_offsets", lambda self, name, groups, start: reads.append(name) or list(range(start, 100)))
    end = reader.latestOffset()
    assert sum(end.values()) == 150 and sorted(reads) == sorted(end)
    reads.clear()
    assert sum(R.StoredRecordsReader(src, 300).latestOffset().values()) == 300 and not reads


def test_bronze_stream_on_stored_records(spark, tmp_path):
    src, root, ck = (str(tmp_path / n) for n in ("src", "lake", "ck"))
    FX.raw_json(spark, SF_SMALL).repartitionByRange(3, "partition", "offset").write.parquet(src)
    n = spark.read.parquet(src).count()
    q = P.bronze_stream(R.stored_record_stream(spark, src, 400), f"{root}/bronze", ck, {"processingTime": "0 seconds"})
    q.processAllAvailable()
    q.stop()
    bronze = spark.read.parquet(f"{root}/bronze")
    assert bronze.count() == n == bronze.select("kafka_partition", "kafka_offset").distinct().count()
    sizes = [r["count"] for r in bronze.groupBy("batch_id").count().collect()]
    assert max(sizes) <= 400 and len(sizes) == -(-n // 400)


def test_a_trigger_opens_few_rows_of_a_stored_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 1 << 12)
    src = str(tmp_path / "src")
    rows = [(o % 3, o) for o in range(12_000)] + [(o % 3, 10 ** 9 + o) for o in range(0, 12_000, 20)]       # far re-deliveries
    R.store(spark.createDataFrame([(f"k{o}", f"v{p}-{o}" * 5, "t", p, o, T0) for p, o in rows], R.SCHEMA).repartition(5), src)
    reader, start, opened, keys, got = R.StoredRecordsReader(src, 600), {}, 0, 0, []
    offsets = R.StoredRecordsReader._offsets

    def counted(self, name, groups, begin):
        nonlocal keys
        keys += sum(g.rows for g in groups)
        return offsets(self, name, groups, begin)
    monkeypatch.setattr(R.StoredRecordsReader, "_offsets", counted)
    while (end := reader.latestOffset()) != start:
        parts = [p for s in reader.partitions(start, end) for p in s.parts]
        size = {(g.file, g.number): g.rows for groups in reader.groups.values() for g in groups}
        opened += sum(size[p.file, p.number] for p in parts)
        batch = [r for s in reader.partitions(start, end) for b in reader.read(s) for r in zip(b["partition"].to_pylist(), b["offset"].to_pylist(), strict=True)]
        assert 0 < len(batch) <= 600
        got += batch
        start = end
    assert sorted(got) == sorted(rows)
    # 21 triggers; with files in any other order each would open every row
    assert opened < 4 * len(rows) and keys < 4 * len(rows), (opened, keys)


def test_a_trigger_reads_the_offsets_of_a_row_group_once(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    monkeypatch.setattr(R, "BLOCK_BYTES", 1 << 12)
    src = str(tmp_path / "src")
    rows = [(o % 3, 5 * o) for o in range(9_000)]
    R.store(spark.createDataFrame([(f"k{o}", f"v{p}-{o}" * 5, "t", p, o, T0) for p, o in rows], R.SCHEMA), src)
    reader, start, opened = R.StoredRecordsReader(src, 90), {}, []
    reader._look()
    groups = sum(map(len, reader.groups.values()))
    read = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda self, n, **k: opened.append(n) or read(self, n, **k))
    triggers = 0
    while (end := reader.latestOffset()) != start:
        reader.partitions(start, end)
        start, triggers = end, triggers + 1
    assert triggers == 100
    assert len(opened) <= groups < 3 * triggers, (len(opened), groups)


def test_offsets_kept_are_bounded_and_change_nothing(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    rows = [(o % 4, 3 * o) for o in range(2_000)]
    _put(spark, src, rows, files=1)
    _put(spark, src, [(p, o + 1) for p, o in rows], files=1)

    def ends(kept):
        monkeypatch.setattr(R, "KEPT_OFFSETS", kept)
        reader, out = R.StoredRecordsReader(src, 130), []
        while (end := reader.latestOffset()) != (out[-1] if out else {}):
            reader.partitions(out[-1] if out else {}, end)
            out.append(end)
            assert reader.kept_offsets == sum(map(len, reader.kept.values())) <= kept
        return out
    assert ends(0) == ends(1_500) == ends(1 << 20)


def test_a_file_written_anew_is_not_read_by_its_old_footer(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    src = tmp_path / "src"
    src.mkdir()

    def read(n):
        kinds = {"key": pa.string(), "value": pa.string(), "topic": pa.string(), "partition": pa.int32(), "offset": pa.int64(), "timestamp": pa.timestamp("us")}
        cols = {"key": ["k"] * n, "value": ["v" * n] * n, "topic": ["t"] * n, "partition": [0] * n, "offset": list(range(n)), "timestamp": [T0] * n}
        pq.write_table(pa.table({c: pa.array(v, kinds[c]) for c, v in cols.items()}), src / "part-0.parquet")
        reader = R.StoredRecordsReader(str(src), 1000)
        return [o for s in reader.partitions({}, reader.latestOffset()) for b in reader.read(s) for o in b["offset"].to_pylist()]
    assert read(20) == list(range(20)) and read(300) == list(range(300))
