"""Batch sinks on Parquet tables.

Row counts come from ``Observation``s attached to the writes, so no write
is followed by a second pass to count (D20).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import marts
from tidepool.session import scratch_folder


NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet table, False when there is none; any other failure is raised."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() in NO_TABLE:
            return False
        raise


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def append_batch(df: DataFrame, path: str, partition_by: Sequence[str] = ("event_date", "event_hour")
                 ) -> int:
    """K2: append a batch to a partitioned table; returns the rows written.

    (The bronze stream writes batch directories instead, see
    ``streaming.streams.write_bronze_batch``, which is retry-safe.)
    """
    counted, obs = _counted(df, "append_batch")
    counted.write.mode("append").partitionBy(*partition_by).parquet(path)
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """K9 on read: files written under older schemas read NULL in newer columns."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("event_date",)) -> int:
    """K5 first write (overwrite, partitioned), else K6 on disk: replace from the least date on.

    The partitions of ``df`` are overwritten in place; partitions on or after
    its least value of the first partition column that it does not have are
    then removed, so a table with 1, 2 and 3 January refreshed with the 2nd
    ends with the 1st and 2nd. An empty ``df`` changes nothing. Both steps may
    be repeated after a failure.

    ``df`` is computed once: its rows go to a scratch table first, whose partition
    directories tell the dates, and from there into place.
    """
    spark = df.sparkSession
    counted, obs = _counted(df, "write_partitioned")
    if not table_exists(spark, path):
        counted.write.partitionBy(*partition_by).mode("overwrite").parquet(path)
        return int(obs.get["rows"])
    by = partition_by[0]
    staged = f"{scratch_folder(spark)}/staged"
    counted.write.partitionBy(*partition_by).parquet(staged)
    rows = int(obs.get["rows"])
    if not rows:
        return 0
    ready = spark.read.schema(_nullable(df.schema)).parquet(staged)
    before = {str(r[0]) for r in spark.read.parquet(path).select(by).distinct().collect()}   # partition values
    kept = {str(r[0]) for r in ready.select(by).distinct().collect()}                        # of directories, no row is read
    (ready.write.partitionBy(*partition_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for value in sorted(v for v in before - kept if v >= min(kept)):
        gone = fs_path(f"{path}/{by}={value}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return rows


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def write_marts(clean: DataFrame, root: str, names: Sequence[str] | None = None) -> dict[str, int]:
    """Compute and write the batch marts; returns rows written per mart.

    The clean input is read once per mart (four jobs), as the marts group by
    different keys; each mart is stamped with ``computed_at``.
    """
    out = {}
    for name, fn in marts.MARTS.items():
        if names and name not in names:
            continue
        out[name] = write_partitioned(marts.stamp(fn(clean)), f"{root}/{name}", ["event_date"])
    return out
