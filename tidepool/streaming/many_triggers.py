"""Queries of many small triggers, whose time is that of the steps around each trigger.

A limit of records a trigger makes the number of triggers grow with the records, so what a trigger waits for counts.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

WRITERS = 16      # triggers written at a time, at most
CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


class WriteBehind:
    """A ``foreachBatch`` function: each trigger's rows are written by one of some threads while the next triggers are taken.

    Every trigger is still written by itself, and at most ``writers`` are in hand; the next one waits. A failed write
    fails a later trigger, or the end of the ``with`` block, which waits for all of them. The checkpoint may count a
    trigger before it is written, so this is for a query with a checkpoint of its own whose output is read after the
    block. One that goes on from an older checkpoint is refused: triggers before its first may not have been written.
    """

    def __init__(self, write: Callable[[DataFrame, int], None], writers: int):
        self.write, self.writers = write, max(1, min(writers, WRITERS))
        self.pool = ThreadPoolExecutor(self.writers)
        self.begun: deque[Future] = deque()
        self.next = 0

    def __call__(self, df: DataFrame, epoch: int) -> None:
        if epoch != self.next:
            raise ValueError(f"trigger {epoch} follows trigger {self.next - 1}: writing behind needs a new checkpoint")
        while self.begun and (len(self.begun) >= self.writers or self.begun[0].done()):
            self.begun.popleft().result()
        self.begun.append(self.pool.submit(self.write, df, epoch))
        self.next += 1

    def __enter__(self) -> WriteBehind:
        return self

    def __exit__(self, kind, *_) -> None:
        self.pool.shutdown(cancel_futures=kind is not None)
        if kind is None:
            for write in self.begun:
                write.result()


def start(spark: SparkSession, stream: DataStreamWriter) -> StreamingQuery:
    """Start a query whose two checkpoint files a trigger are written through Hadoop's FileSystem.

    Spark goes this way itself where a file system has no FileContext, which starts processes for every local file. A
    choice the session has made stays.
    """
    if spark.conf.get(CHECKPOINT_FILES, None):
        return stream.start()
    spark.conf.set(CHECKPOINT_FILES, BY_FILE_SYSTEM)
    try:
        return stream.start()
    finally:
        spark.conf.unset(CHECKPOINT_FILES)
