"""Table statistics and layout jobs on Parquet tables.

Layout jobs read a table (or the partitions a filter selects), re-shuffle
it and write a new copy; the row multiset never changes. Z-order clusters
rows on several columns so Parquet row-group min/max statistics can skip
data for filters on any of them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.sinks import table_exists


def table_stats(df: DataFrame, date_col: str = "event_date", type_col: str = "event_type") -> DataFrame:
    """Rows, distinct dates, sorted event types, date range, in ONE aggregate.

    The event-type list is bounded by the (small) domain of event types.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(date_col).alias("partitions"),
        F.array_join(F.array_sort(F.collect_set(type_col)), ",").alias("event_types"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
    )


def file_stats(df: DataFrame) -> DataFrame:
    """Per data file: path, bytes, rows (from the hidden ``_metadata`` column)."""
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("num_rows"))


def table_details(spark: SparkSession, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """One row: path, format, files, bytes, MB, partitioning, rows, columns."""
    df = spark.read.parquet(path)
    files = file_stats(df)
    cols = df.columns
    return files.agg(
        F.lit(path).alias("path"),
        F.lit("parquet").alias("format"),
        F.count(F.lit(1)).alias("num_files"),
        F.sum("file_size").alias("size_bytes"),
        F.round(F.sum("file_size") / (1024 * 1024), 2).alias("size_mb"),
        F.array(*[F.lit(c) for c in partition_cols]).cast("array<string>").alias("partitioning"),
        F.sum("num_rows").alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
        F.array(*[F.lit(c) for c in cols]).alias("columns"),
    )


def _select(spark: SparkSession, path: str, where: str | None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.expr(where)) if where else df   # K13: partition-filtered


def compact(spark: SparkSession, path: str, out_path: str, partition_cols: Sequence[str] = (),
            where: str | None = None, target_file_bytes: int = 128 * 1024 * 1024) -> None:
    """Rewrite (the selected partitions of) a table as few, large files.

    ``rebalance`` lets AQE size the output partitions to the advisory size
    (and split skewed partition values) instead of a guessed file count.
    """
    df = _select(spark, path, where)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key, None)
    spark.conf.set(key, str(int(target_file_bytes)))
    try:
        out = df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")
        out.write.mode("overwrite").partitionBy(*partition_cols).parquet(out_path)
    finally:
        if prev is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, prev)


# ------------------------------------------------------------------ Z-order

def _tree(c: Column, cuts: list, lo: int, hi: int) -> Column:
    """Bucket index of ``c`` among sorted ``cuts[lo:hi]`` as a balanced CASE tree
    (log2(buckets) comparisons per row, all in generated code)."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(c < F.lit(cuts[mid]), _tree(c, cuts, lo, mid)).otherwise(_tree(c, cuts, mid + 1, hi))


def quantile_cuts(df: DataFrame, column: str, buckets: int, sample_rows: int = 200_000,
                  seed: int = 7, n: int | None = None) -> list:
    """Sorted cut points giving ~equal-count buckets of ``column``.

    Works for any orderable type. Only a bounded sample (about
    ``sample_rows`` values) reaches the driver, sized from the row count
    ``n``, the same way Spark's range partitioner samples its bounds.
    """
    n = df.count() if n is None else n
    if n == 0:
        return []
    frac = min(1.0, sample_rows / n)
    vals = sorted(r[0] for r in df.select(column).sample(fraction=frac, seed=seed)
                  .dropna().collect())
    if not vals:
        return []
    step = len(vals) / buckets
    cuts = sorted({vals[min(len(vals) - 1, int(step * i))] for i in range(1, buckets)})
    return cuts


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Interleaved-bit (Morton) key over per-column quantile buckets."""
    buckets = 1 << bits
    n = df.count()
    ids = []
    for c in columns:
        cuts = quantile_cuts(df, c, buckets, n=n)
        b = _tree(F.col(c), cuts, 0, len(cuts)) if cuts else F.lit(0)
        ids.append(F.coalesce(b, F.lit(0)).cast("long"))
    k = len(columns)
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for j, b in enumerate(ids):
            z = z + F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)), bit * k + j)
    return z


def zorder(df: DataFrame, columns: Sequence[str], num_files: int | None = None, bits: int = 6) -> DataFrame:
    """Rows range-partitioned and sorted on the Z-key (then dropped).

    Inside a Z-cell rows are ordered by the columns themselves, so cells that
    hold many values still skip; a hash of the whole row breaks the last ties,
    so rows sharing one value (a hot key) spread over several files, and a
    retried task writes the same rows. Without ``num_files`` the session's
    shuffle width and AQE's target size decide how many files there are.
    """
    cols = [F.col(c) for c in df.columns]
    keyed = df.withColumns({"_z": zorder_key(df, columns, bits), "_h": F.xxhash64(*cols)})
    order = ["_z", *columns, "_h"]
    dealt = keyed.repartitionByRange(num_files, *order) if num_files else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("_z", "_h")


def partitioning(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a stored table, read off one data file's folders."""
    one = spark.read.parquet(path).select("_metadata.file_path").head()
    known = spark.read.parquet(path).columns
    return [c for c in re.findall(r"/([^/=]+)=", one[0]) if c in known] if one else []


def optimize(spark: SparkSession, path: str, out_path: str, zorder_columns: Sequence[str] | None = None,
             where: str | None = None, partition_cols: Sequence[str] | None = None,
             num_files: int | None = None) -> DataFrame:
    """Write (the partitions that ``where`` selects of) a table compacted or Z-ordered to
    ``out_path``, partitioned as the table is unless told otherwise; returns its details."""
    by = partitioning(spark, path) if partition_cols is None else list(partition_cols)
    if not zorder_columns:
        compact(spark, path, out_path, by, where)
    else:
        zorder(_select(spark, path, where), zorder_columns, num_files).write.mode("overwrite").partitionBy(*by).parquet(out_path)
    return table_details(spark, out_path, by)


def optimize_in_place(spark: SparkSession, path: str, staging: str, zorder_columns: Sequence[str] | None = None,
                      where: str | None = None) -> DataFrame:
    """K11-K13 on a table in use: the selected partitions are rewritten, the others stay.

    The new files are written to ``staging`` (a shared folder) and then replace
    the partitions they belong to. Run again, both steps give the same table. A table of
    batch directories is what streams read, to whom new files are new rows: it is refused
    (``compact_copy`` serves its readers).
    """
    by = partitioning(spark, path)
    if "batch_id" in by:
        raise ValueError(f"{path} holds batches that streams read; use compact_copy")
    optimize(spark, path, staging, zorder_columns, where, by)
    ready = spark.read.schema(spark.read.parquet(path).schema).parquet(staging)
    writer = ready.write.mode("overwrite").partitionBy(*by)
    (writer.option("partitionOverwriteMode", "dynamic") if by else writer).parquet(path)
    return table_details(spark, path, by)


# Z-order columns per table; other tables are compacted.
DEFAULT_ZORDER = {
    "bronze": ["event_date", "event_type"],
    "silver": ["event_date", "user_id"],
    "gold_revenue": ["event_date", "category"],
}
MAINTAINED = "table string, status string, num_files long, row_count long"


def optimize_all(spark: SparkSession, tables: dict[str, str], out_root: str,
                 zorder_config: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per table: ``optimized``, ``absent`` or ``failed`` with the reason; one table's
    trouble does not keep the others waiting. Partitioning is kept."""
    chosen = DEFAULT_ZORDER if zorder_config is None else zorder_config

    def maintained(name: str, path: str) -> tuple:
        if not table_exists(spark, path):
            return name, "absent", None, None
        try:
            row = optimize(spark, path, f"{out_root}/{name}", chosen.get(name)).first()
        except PySparkException as e:
            return name, f"failed: {e}", None, None
        return name, "optimized", int(row["num_files"]), int(row["row_count"])

    return spark.createDataFrame([maintained(*t) for t in tables.items()], MAINTAINED)


# ------------------------------------------------------------------ a compact copy beside a streamed table

BATCH_NUMBER = r"(\d+)$"      # the batch's number at the end of its id
MERGE_OVER = 8                # ranges of a copy that are made one


def _number() -> Column:
    return F.regexp_extract(F.col("batch_id"), BATCH_NUMBER, 1).cast("long")


def _ranges(spark: SparkSession, copy: str) -> list[tuple[int, int]]:
    """Batch ranges a copy holds; one inside a wider one has been merged into it."""
    if not table_exists(spark, copy):
        return []
    found = [tuple(r) for r in spark.read.parquet(copy).select("first", "last").distinct().collect()]
    return sorted(r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found))


def _of_ranges(ranges: Sequence[tuple[int, int]]) -> Column:
    held = F.lit(False)
    for first, last in ranges:
        held = held | ((F.col("first") == first) & (F.col("last") == last))
    return held


def compact_copy(spark: SparkSession, path: str, copy: str, schema, partition_cols: Sequence[str] = ("event_date", "event_hour"),
                 upto: int | None = None, merge_over: int = MERGE_OVER, target_file_bytes: int = 128 * 1024 * 1024) -> list[tuple[int, int]]:
    """K11/K13 on a table that streams read: its new batches, as few large files, to a copy for readers.

    The batch directories of the table (``batch_id=<name>_<n>``) are left as they are, so a stream over them sees no
    new files and cleans nothing twice. Each run writes the batches after the copy's last to
    ``copy/first=<a>/last=<b>``; more than ``merge_over`` such ranges are written together as one, and readers use the
    widest. A range's directory is overwritten by a retry. Without ``upto`` the newest batch waits for the next run, as only
    that one may still be rewritten by a retried trigger. Returns the ranges of the copy.
    """
    ranges = _ranges(spark, copy)
    done = ranges[-1][1] if ranges else -1
    table = spark.read.schema(schema).parquet(path).withColumn("_n", _number())
    if upto is None:
        newest = table.agg(F.max("_n")).first()[0]
        upto = -1 if newest is None else newest - 1
    if upto <= done:
        return ranges
    rows, first = table.filter((F.col("_n") > done) & (F.col("_n") <= upto)).drop("_n"), done + 1
    if len(ranges) >= merge_over:
        held = spark.read.schema(_copy_schema(schema)).parquet(copy).filter(_of_ranges(ranges)).drop("first", "last")
        rows, first = held.unionByName(rows), ranges[0][0]
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(int(target_file_bytes)))
    try:
        rows.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).parquet(f"{copy}/first={first}/last={upto}")
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    return _ranges(spark, copy)


def _copy_schema(schema):
    return type(schema)([*schema.fields]).add("first", "long").add("last", "long")


def read_compacted(spark: SparkSession, path: str, copy: str, schema) -> DataFrame:
    """The whole table: compacted batches from the copy, later ones from the table itself. Both tests are on directories, so
    each batch's files are listed and read in one of the two places only."""
    ranges = _ranges(spark, copy)
    table = spark.read.schema(schema).parquet(path)
    if not ranges:
        return table
    held = spark.read.schema(_copy_schema(schema)).parquet(copy).filter(_of_ranges(ranges)).drop("first", "last")
    return held.unionByName(table.filter((_number() > ranges[-1][1]) | (_number() < ranges[0][0])))
