"""Queries of many small triggers: writes behind the stream, checkpoint files."""

import threading

import pytest

from tests.test_record_source import _put
from tidepool.sources import record_source as R
from tidepool.streaming import many_triggers as M


def _stream(spark, src, batches, ck, limit):
    return R.stored_record_stream(spark, src, limit).writeStream.foreachBatch(batches).option("checkpointLocation", ck)


def test_triggers_go_on_while_one_is_written_and_none_is_lost(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    rows = [(o % 3, 2 * o) for o in range(700)]
    _put(spark, src, rows)
    third, waited, in_hand, most, lock = threading.Event(), [], set(), [], threading.Lock()

    def write(df, epoch):
        with lock:
            in_hand.add(epoch)
            most.append(len(in_hand))
        if epoch == 2:
            third.set()
        if epoch == 0:
            waited.append(third.wait(60))         # ends only if later triggers come meanwhile
        df.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        with lock:
            in_hand.remove(epoch)
    with M.WriteBehind(write, 3) as batches:
        q = M.start(spark, _stream(spark, src, batches, ck, 50))
        q.processAllAvailable()
        q.stop()
    assert waited == [True] and 2 <= max(most) <= 3
    got = spark.read.parquet(out)
    assert sorted((r["partition"], r["offset"]) for r in got.collect()) == sorted(rows)
    sizes = [r["count"] for r in got.groupBy("epoch").count().collect()]
    assert sizes == [50] * 14


def test_a_failed_write_fails_the_query(spark, tmp_path):
    src = str(tmp_path / "src")
    _put(spark, src, [(0, o) for o in range(100)])

    def run(bad, ck):
        def write(df, epoch):
            if epoch == bad:
                raise OSError("disk is gone")
            df.count()
        with M.WriteBehind(write, 2) as batches:
            q = M.start(spark, _stream(spark, src, batches, str(tmp_path / ck), 10))
            try:
                q.processAllAvailable()
            finally:
                q.stop()
    with pytest.raises(Exception, match="disk is gone"):
        run(1, "early")
    with pytest.raises(OSError, match="disk is gone"):
        run(9, "last")
    with pytest.raises(Exception, match="new checkpoint"):
        _put(spark, src, [(0, 100 + o) for o in range(10)])
        run(99, "last")


def test_checkpoint_files_are_chosen_for_the_start_alone(spark, tmp_path):
    class Writer:
        def start(self):
            return spark.conf.get(M.CHECKPOINT_FILES, None)
    assert M.start(spark, Writer()) == M.BY_FILE_SYSTEM and spark.conf.get(M.CHECKPOINT_FILES, None) is None
    spark.conf.set(M.CHECKPOINT_FILES, "mine")
    try:
        assert M.start(spark, Writer()) == "mine" == spark.conf.get(M.CHECKPOINT_FILES)
    finally:
        spark.conf.unset(M.CHECKPOINT_FILES)
