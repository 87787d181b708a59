"""Typed table schemas, compatibility checks and schema gates.

Schemas are compared as values; row work (gating, conforming, routing
rejects) stays in DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.expressions import MONEY
from tidepool.sources.ingest import EVENT_SCHEMA

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
TS = T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


_PAYLOAD = [f for f in EVENT_SCHEMA.fields if f.name != "properties"]

# Raw table: 21 payload fields + envelope + ingest metadata (33 columns).
BRONZE_SCHEMA = T.StructType(
    [_f(f.name, f.dataType) for f in _PAYLOAD] + [
        _f("kafka_key", S), _f("kafka_topic", S), _f("kafka_partition", I),
        _f("kafka_offset", L), _f("kafka_timestamp", TS), _f("ingestion_timestamp", T.TimestampType()),
        _f("event_timestamp", TS), _f("row_hash", S), _f("batch_id", S), _f("source_system", S),
        _f("event_date", S), _f("event_hour", I),
    ])
BRONZE_PARTITIONS = ["event_date", "event_hour"]

# Clean table, 29 columns in order; NOT NULL on id, type and event time.
SILVER_SCHEMA = T.StructType([
    _f("event_id", S, False), _f("event_type", S, False), _f("user_id", S), _f("session_id", S),
    _f("event_timestamp", TS, False), _f("product_id", S), _f("product_name", S), _f("category", S),
    _f("price", MONEY), _f("quantity", I), _f("total_amount", T.DecimalType(29, 2)), _f("currency", S),
    _f("device_type", S), _f("browser", S), _f("os", S), _f("country", S), _f("city", S),
    _f("referrer", S), _f("utm_source", S), _f("utm_medium", S), _f("utm_campaign", S),
    _f("channel_group", S), _f("row_hash", S), _f("bronze_batch_id", S),
    _f("silver_processed_at", T.TimestampType()), _f("data_quality_score", T.DoubleType()),
    _f("quality_flags", S), _f("event_date", S), _f("event_hour", I),
])
SILVER_PARTITIONS = ["event_date"]

MODES = ("BACKWARD", "FORWARD", "FULL", "NONE")

# Pairs of types whose every value survives the change.
_WIDENING = {
    ("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"), ("short", "long"),
    ("integer", "long"), ("integer", "double"), ("float", "double"),
}


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return old == new or (old.typeName(), new.typeName()) in _WIDENING


def compatibility_errors(old: T.StructType, new: T.StructType, mode: str = "BACKWARD",
                         check_types: bool = True) -> list[str]:
    """What keeps rows of ``new`` from joining a table of ``old`` under ``mode``.

    A required field must not come (all modes) nor go (BACKWARD, FULL); a
    field's type may only widen (``check_types``). NONE allows everything.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode}")
    if mode == "NONE":
        return []
    before, after = ({f.name: f for f in x.fields} for x in (old, new))
    gone = [n for n, f in before.items() if n not in after and not f.nullable] if mode != "FORWARD" else []
    come = [n for n, f in after.items() if n not in before and not f.nullable]
    changed = [n for n in before if n in after and not _widens(before[n].dataType, after[n].dataType)] if check_types else []
    return ([f"{n}: required by the table, missing in the batch" for n in gone]
            + [f"{n}: required in the batch, unknown to the table" for n in come]
            + [f"{n}: {before[n].dataType.simpleString()} does not widen to {after[n].dataType.simpleString()}" for n in changed])


def gated_append(table: DataFrame | None, batch: DataFrame, mode: str = "BACKWARD",
                 declared: T.StructType | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """G1: (table with the batch appended, None), or (None, the batch's rows with ``error_reason``).

    The batch is held against ``declared``, else the table's own schema (files
    read back have only nullable fields, so required ones need declaring). A
    batch that fits is appended with additive evolution (K9); one that does
    not is never appended: its rows go to the dead letters.
    """
    known = declared or (table.schema if table is not None else None)
    errors = compatibility_errors(known, batch.schema, mode) if known is not None else []
    if errors:
        return None, batch.withColumn("error_reason", F.lit("; ".join(errors)))
    return (batch if table is None else table.unionByName(batch, allowMissingColumns=True)), None


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows in the declared schema, rejected rows with ``error_reason``).

    Declared columns are cast (``try_cast``: a bad value becomes NULL, not
    an error), missing ones are added as NULL, extra ones dropped. A row
    with a NULL in a NOT NULL column is rejected.
    """
    cols = []
    for f in schema.fields:
        src = F.col(f.name).try_cast(f.dataType) if f.name in df.columns \
            else F.lit(None).cast(f.dataType)
        cols.append(src.alias(f.name))
    typed = df.select(*cols)
    required = [f.name for f in schema.fields if not f.nullable]
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in required]) \
        if required else F.lit("")
    tagged = typed.withColumn("error_reason", reason)
    ok = tagged.filter(F.col("error_reason") == "").drop("error_reason")
    return ok, tagged.filter(F.col("error_reason") != "")


def initialize_table(spark: SparkSession, path: str, schema: T.StructType,
                     partition_by: Sequence[str] = ()) -> None:
    """Create an empty typed, partitioned Parquet table unless one exists."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)
