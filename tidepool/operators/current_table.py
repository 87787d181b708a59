"""The current table kept up to date batch by batch, without a pass over the whole change log.

Rows lie in ``<path>/buckets=<n>/bucket=<b>``, the bucket being a hash of the key below ``n``. An upsert finds the
buckets that its keys fall in, reads these alone (partition pruning), keeps the latest row per key of what was there
and what came, and replaces these directories by a dynamic partition overwrite. All other buckets are neither
read nor written, so the cost follows the batch, not the table.

* One shuffle, by bucket, serves the latest-per-key window and the write: a bucket is one task and one file. Keys are
  spread by hash, and a key has one row, so buckets stay even; choose ``n`` so that a bucket is some 100 MB.
* Tombstones stay (readers drop them), so an older delivery that comes late cannot bring a deleted key back.
* The same batch again changes nothing (latest per key is idempotent), which makes it fit for ``foreachBatch``.
* The change log stays the truth: ``rebuild`` writes buckets anew from it, all or some.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.changelog import KEY, LOG_META, RECENCY
from tidepool.operators.refine import dedup_latest
from tidepool.operators.sinks import table_exists

BUCKETS = 64
BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def _folder(path: str, buckets: int) -> str:
    return f"{path}/buckets={int(buckets)}"


def _known_width(spark: SparkSession, path: str, buckets: int) -> bool:
    """Whether the table exists; a table with another number of buckets is an error, not a second table."""
    if table_exists(spark, _folder(path, buckets)):
        return True
    if table_exists(spark, path):
        raise ValueError(f"{path} has another number of buckets than {buckets}")
    return False


def _write(rows: DataFrame, path: str, buckets: int, key: str, order: Sequence[str]) -> None:
    """Latest row per key of ``rows``; the buckets they fall in are replaced."""
    # the bucket leads the window's key, so the one exchange by bucket serves it as well
    tagged = rows.drop(BUCKET).withColumn(BUCKET, bucket_of(key, buckets)).repartition(F.col(BUCKET))
    latest = dedup_latest(tagged, key=[BUCKET, key], order=order)
    (latest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(_folder(path, buckets)))


def upsert(batch: DataFrame, path: str, key: str = KEY, buckets: int = BUCKETS,
           order: Sequence[str] = RECENCY) -> list[int]:
    """Fold a log batch (rows with the recency columns and ``is_deleted``) into the table; returns the buckets hit.

    ``batch`` is evaluated twice (its buckets, then its rows): pass a stored batch. At most ``buckets`` numbers
    reach the driver. An empty batch writes nothing.
    """
    spark = batch.sparkSession
    hit = sorted(r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect())
    if not hit:
        return []
    if _known_width(spark, path, buckets):
        there = spark.read.schema(_stored(batch)).parquet(_folder(path, buckets)).filter(F.col(BUCKET).isin(hit))
        batch = there.drop(BUCKET).unionByName(batch)
    _write(batch, path, buckets, key, order)
    return hit


def _stored(batch: DataFrame) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in batch.schema.fields if f.name != BUCKET]
    return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])


def read(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS,
         keys: Sequence | None = None, key: str = KEY, keep_meta: bool = False) -> DataFrame:
    """The live rows. With ``keys``, only the buckets these fall in are read (a point lookup).

    ``schema`` is the log's (``streams.log_schema``), as for ``changelog.read_log``.
    """
    fields = [f for f in schema.fields if f.name != BUCKET]
    table = spark.read.schema(T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])).parquet(_folder(path, buckets))
    if keys is not None:
        wanted = spark.createDataFrame([(k,) for k in keys], T.StructType([schema[key]]))
        hit = [r[0] for r in wanted.select(bucket_of(key, buckets)).distinct().collect()]
        table = table.filter(F.col(BUCKET).isin(hit) & F.col(key).isin(list(keys)))
    live = table.filter(~F.col("is_deleted")).drop(BUCKET)
    return live if keep_meta else live.drop(*[c for c in LOG_META if c in live.columns])


def rebuild(log: DataFrame, path: str, key: str = KEY, buckets: int = BUCKETS, order: Sequence[str] = RECENCY,
            only: Sequence[int] | None = None) -> None:
    """Write the table, or the buckets ``only``, from the whole change log (first load, repair, other width elsewhere)."""
    _known_width(log.sparkSession, path, buckets)
    if only is not None:
        log = log.filter(bucket_of(key, buckets).isin(list(only)))
    _write(log, path, buckets, key, order)
