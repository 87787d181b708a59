"""A streaming source of stored Kafka-shaped records that counts records, not files.

Spark's file source limits a trigger by files. This one (``spark.readStream.format("stored_records")``) reads Parquet
files of records (``ingest.RECORD_SCHEMA``) and gives at most ``maxRecordsPerTrigger`` of them a trigger. Its offsets
are those of the records: for every topic and partition the next one to read, as Kafka's are, so a restarted query
goes on where its checkpoint stands, whatever files have been added meanwhile.

The driver looks at file footers alone: each row group of one topic partition counts by its statistics. Only where a
trigger's limit falls inside a row group (or inside row groups whose offsets overlap) are their offsets read. Row
groups that mix partitions have their three key columns read once. Rows themselves are read by the tasks, each some
whole row groups. Offsets may have gaps; within a topic partition each stands once. Footers and offsets that the next
trigger needs again are kept, a bounded number of them.

A trigger reads the row groups its offsets lie in, so its cost does not grow with the records stored when the files
are in the order of the log, their row groups small and their footers short: ``store`` writes them so. Any other layout
gives the same records, at the cost of reading a row group once for each trigger that takes a part of it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp_ntz"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
LIMIT = 500
BLOCK_BYTES = 1 << 19      # a row group of ``store``
FILE_ROWS = 250_000        # a file of ``store``: a trigger reads the footer of each file it opens
TASK_ROWS = 16_000         # a task opens row groups up to about so many rows
KEPT_FOOTERS = 16          # of a process
KEPT_OFFSETS = 1 << 20     # of a reader


@dataclass(frozen=True)
class Group:
    """The records of one topic partition in one row group."""

    file: str
    stamp: int
    number: int
    first: int
    last: int
    rows: int


@dataclass(frozen=True)
class Part:
    """Some offsets of one topic partition in one row group."""

    file: str
    stamp: int
    number: int
    topic: str
    partition: int
    start: int
    end: int


@dataclass
class Slice(InputPartition):
    parts: list[Part]


@lru_cache(KEPT_FOOTERS)
def _open(path: str):
    import pyarrow.fs
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@lru_cache(KEPT_FOOTERS)
def _footer(path: str, file: str, stamp: int):
    """Footer of a file as it was at ``stamp``."""
    import pyarrow.parquet as pq
    store, _ = _open(path)
    with store.open_input_file(file) as opened:
        return pq.read_metadata(opened)


def _parquet(path: str, file: str, stamp: int):
    import pyarrow.parquet as pq
    store, _ = _open(path)
    return pq.ParquetFile(store.open_input_file(file), metadata=_footer(path, file, stamp))


def _name(topic: str, partition: int) -> str:
    return f"{topic}/{partition}"


class StoredRecordsReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int):
        self.path, self.limit = path, limit
        self.position: dict[str, int] = {}
        self.planned: dict[str, int] | None = None     # the end that was given last
        self.seen: set[str] = set()
        self.groups: dict[str, list[Group]] = {}       # by topic partition, rising
        self.lasts: dict[str, list[int]] = {}          # the greatest offset so far, beside each group
        self.kept: OrderedDict[tuple, list[int]] = OrderedDict()     # offsets of row groups, the last used at the end
        self.kept_offsets = 0

    def __getstate__(self) -> dict:
        # tasks need the place only, not the driver's index
        return StoredRecordsReader(self.path, self.limit).__dict__

    # -------------------------------------------------------------- index (driver)

    def _look(self) -> None:
        """Footers of files not seen before."""
        import pyarrow.fs
        import pyarrow.parquet as pq
        store, base = _open(self.path)
        grown = set()
        for info in store.get_file_info(pyarrow.fs.FileSelector(base, recursive=True, allow_not_found=True)):
            inner = info.path[len(base):].strip("/").split("/")
            if info.path in self.seen or not info.is_file or not info.path.endswith(".parquet") or any(p[0] in "._" for p in inner):
                continue
            self.seen.add(info.path)
            file = pq.ParquetFile(store.open_input_file(info.path))
            stamp = hash((info.size, info.mtime_ns))
            at = {file.schema_arrow.names[i]: i for i in range(len(file.schema_arrow.names))}
            for n in range(file.metadata.num_row_groups):
                stats = {c: file.metadata.row_group(n).column(at[c]).statistics for c in ("topic", "partition", "offset")}
                if all(s is not None and s.has_min_max for s in stats.values()) and all(stats[c].min == stats[c].max for c in ("topic", "partition")):
                    parts = [(stats["topic"].min, stats["partition"].min, stats["offset"].min, stats["offset"].max, file.metadata.row_group(n).num_rows)]
                else:
                    keys = file.read_row_group(n, columns=["topic", "partition", "offset"])
                    found = keys.group_by(["topic", "partition"]).aggregate([("offset", "min"), ("offset", "max"), ("offset", "count")]).to_pylist()
                    parts = [(g["topic"], g["partition"], g["offset_min"], g["offset_max"], g["offset_count"]) for g in found]
                for topic, partition, first, last, rows in parts:
                    if rows:
                        self.groups.setdefault(_name(topic, partition), []).append(Group(info.path, stamp, n, first, last, rows))
                        grown.add(_name(topic, partition))
        for name in grown:
            self.groups[name].sort(key=lambda g: (g.first, g.last))
            self.lasts[name] = list(accumulate((g.last for g in self.groups[name]), max))

    def _first(self, name: str, start: int) -> int:
        """Number of the first group that may hold ``start`` or a later offset."""
        return bisect_left(self.lasts[name], start)

    def _offsets(self, name: str, groups: list[Group], start: int) -> list[int]:
        """Offsets from ``start`` on in some row groups, rising."""
        import pyarrow.compute as pc
        topic, partition = name.rsplit("/", 1)
        key = (name, *((g.file, g.number) for g in groups))
        out = self.kept.pop(key, None)
        if out is None:
            out = []
            for g in groups:
                keys = _parquet(self.path, g.file, g.stamp).read_row_group(g.number, columns=["topic", "partition", "offset"])
                mine = pc.and_(pc.equal(keys["topic"], topic), pc.equal(keys["partition"], int(partition)))
                out += pc.drop_null(keys.filter(mine)["offset"]).to_pylist()
            out.sort()
            self.kept_offsets += len(out)
        # the next trigger goes on in the same row groups
        self.kept[key] = out
        while self.kept_offsets > KEPT_OFFSETS:
            self.kept_offsets -= len(self.kept.popitem(last=False)[1])
        return out[bisect_left(out, start):]

    def _advance(self, name: str, start: int, budget: int) -> tuple[int, int]:
        """(next offset after at most ``budget`` records from ``start`` on, records taken)."""
        groups = self.groups[name]
        end, taken, i = start, 0, self._first(name, start)
        while i < len(groups) and taken < budget:
            # row groups whose offsets overlap are one stretch
            j, last = i + 1, groups[i].last
            while j < len(groups) and groups[j].first <= last:
                last = max(last, groups[j].last)
                j += 1
            stretch = [g for g in groups[i:j] if g.last >= start]
            whole = stretch[0].first >= start
            rows = sum(g.rows for g in stretch)
            if whole and taken + rows <= budget:
                end, taken = last + 1, taken + rows
            else:
                offsets = self._offsets(name, stretch, max(start, end))
                some = offsets[:budget - taken]
                end, taken = some[-1] + 1 if len(some) < len(offsets) else last + 1, taken + len(some)
            i = j
        return end, taken

    def latestOffset(self) -> dict:
        self._look()
        end, budget = dict(self.position), self.limit
        while budget:
            # an equal share for each partition; what one does not need goes to the others
            waiting = [n for n, lasts in sorted(self.lasts.items()) if lasts[-1] >= end.get(n, 0)]
            if not waiting:
                break
            for k, name in enumerate(waiting):
                end[name], taken = self._advance(name, end.get(name, 0), -(-budget // (len(waiting) - k)))
                budget -= taken
        self.planned = dict(end)
        return end

    def initialOffset(self) -> dict:
        return {}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # also called with start == end when a query goes on from its checkpoint
        self.position = dict(end)
        if end != self.planned:
            self._look()
        out, rows = [], 0
        for name, stop in end.items():
            begin = start.get(name, 0)
            topic, partition = name.rsplit("/", 1)
            if begin >= stop or name not in self.groups:
                continue
            for g in self.groups[name][self._first(name, begin):]:
                if g.first >= stop:
                    break
                if g.last < begin:
                    continue
                if not out or rows + g.rows > TASK_ROWS:
                    out.append(Slice([]))
                    rows = 0
                out[-1].parts.append(Part(g.file, g.stamp, g.number, topic, int(partition), begin, stop))
                rows += g.rows
        return out

    # -------------------------------------------------------------- rows (tasks)

    def read(self, partition: Slice) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        kinds = pa.schema([("key", pa.string()), ("value", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                           ("timestamp", pa.timestamp("us"))])
        for (name, stamp), parts in groupby(partition.parts, lambda p: (p.file, p.stamp)):
            file = _parquet(self.path, name, stamp)
            for part in parts:
                rows = file.read_row_group(part.number, columns=COLUMNS)
                mine = pc.and_(pc.equal(rows["topic"], part.topic), pc.equal(rows["partition"], part.partition))
                inside = pc.and_(pc.greater_equal(rows["offset"], part.start), pc.less(rows["offset"], part.end))
                yield from rows.filter(pc.and_(mine, inside)).select(COLUMNS).cast(kinds).combine_chunks().to_batches()


class StoredRecords(DataSource):
    """``format("stored_records")`` with the options ``path`` and ``maxRecordsPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return "stored_records"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> StoredRecordsReader:
        limit = int(self.options.get("maxRecordsPerTrigger", LIMIT))
        if limit < 1:
            raise ValueError("maxRecordsPerTrigger must be positive")
        return StoredRecordsReader(self.options["path"], limit)


def stored_record_stream(spark: SparkSession, path: str, max_records_per_trigger: int = LIMIT) -> DataFrame:
    """Streaming records of the Parquet files below ``path``, at most so many a trigger."""
    spark.dataSource.register(StoredRecords)
    return spark.readStream.format(StoredRecords.name()).option("path", path).option("maxRecordsPerTrigger", max_records_per_trigger).load()


def store(records: DataFrame, path: str) -> None:
    """Write records as a log: ordered by topic, partition and offset, in row groups that a trigger may read a few of."""
    log = ["topic", "partition", "offset"]
    files = records.repartitionByRange(*log).sortWithinPartitions(*log).write.option("parquet.block.size", BLOCK_BYTES)
    files.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
