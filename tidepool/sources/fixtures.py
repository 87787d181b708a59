"""Raw-event view over the driver's ``events`` table (FIXTURES.md §3).

The test data has no e-commerce payload, so a deterministic mapping turns
each ``events`` row into a raw event with a Kafka-style envelope, with
NULLs, case noise, empty strings and re-delivered copies injected.

Every column expression is written once, as SQL text that Spark and DuckDB
both accept, so the oracle sees the very same input rows. Spark evaluates
the text with ``F.expr`` inside one projection: no UDF, full codegen, and
column pruning still reaches the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Inner projection ``x`` over ``events``: (name, spark text, duckdb text).
_INNER = [
    ("eid", "event_id", "event_id"),
    ("uid", "user_id", "user_id"),
    ("ts", "ts", "ts"),
    ("value", "value", "value"),
    ("k", "cast(get_json_object(props, '$.k') as int)",
     "cast(json_extract_string(props, '$.k') as int)"),
    ("et", "case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart' "
           "when 'signup' then 'checkout' when 'purchase' then 'purchase' "
           "when 'error' then 'search' end", None),
]

# Fixed values of the fixture mapping (FIXTURES.md §3), same text in both engines.
RAW_COLUMNS = [
    ("event_id", "concat('evt-', lpad(cast(eid as string), 9, '0'))"),
    ("event_type", "case when eid % 7 = 0 then concat(' ', upper(et), ' ') else et end"),
    ("user_id", "case when eid % 11 = 0 then null else concat('user_', uid) end"),
    ("session_id", "case when eid % 23 = 0 then null else concat('sess_', uid, '_', k % 10) end"),
    ("timestamp", "concat(replace(cast(ts as string), ' ', 'T'), 'Z')"),
    ("product_id", "case when k % 13 = 0 then null else concat('PROD-', k % 20) end"),
    ("product_name", "case when k % 13 = 0 then null else concat('Product ', k % 20) end"),
    ("category", "case k % 4 when 0 then 'Electronics' when 1 then 'clothing' when 2 then ' home ' else null end"),
    ("price", "case when k % 13 = 0 then null else cast(value as decimal(18,2)) end"),
    ("quantity", "case when k % 17 = 0 then null else k % 5 + 1 end"),
    ("currency", "case when eid % 19 = 0 then null else 'USD' end"),
    ("device_type", "case uid % 4 when 0 then 'mobile' when 1 then 'Desktop' when 2 then 'tablet' else null end"),
    ("browser", "case uid % 5 when 0 then 'Chrome' when 1 then 'safari' when 2 then 'firefox' when 3 then 'edge' else null end"),
    ("os", "case uid % 6 when 0 then 'iOS' when 1 then 'Android' when 2 then 'Windows' when 3 then 'macOS' when 4 then 'Linux' else null end"),
    ("ip_address", "concat('10.0.', uid % 256, '.', k)"),
    ("country", "case uid % 10 when 0 then 'US' when 1 then 'UK' when 2 then 'CA' when 3 then 'DE' when 4 then 'FR' when 5 then ' jp ' when 6 then '' else null end"),
    ("city", "case uid % 7 when 0 then 'New York' when 1 then 'London' when 2 then 'Toronto' when 3 then 'Berlin' when 4 then 'Tokyo' else null end"),
    ("referrer", "case k % 3 when 0 then 'Google.com' when 1 then 'facebook.com' else null end"),
    ("utm_source", "case k % 7 when 0 then 'google' when 1 then 'facebook' when 2 then 'direct' when 3 then 'email' when 4 then 'twitter' else null end"),
    ("utm_medium", "case eid % 9 when 0 then 'cpc' when 1 then 'organic' when 2 then 'social' when 3 then 'email' when 4 then 'referral' when 5 then 'paid' when 6 then 'CPC' when 7 then 'none' else null end"),
    ("utm_campaign", "case k % 5 when 0 then 'summer_sale' when 1 then 'flash_deal' else null end"),
    ("event_timestamp", "ts"),
    ("kafka_key", "concat('user_', uid)"),
    ("kafka_topic", "'ecommerce_events'"),
    ("kafka_partition", "cast(uid % 6 as int)"),
    ("kafka_offset", "eid"),
    ("kafka_timestamp", "ts"),
]

# The 21 payload fields serialised into the raw JSON ``value``.
PAYLOAD_FIELDS = [n for n, _ in RAW_COLUMNS[:21]]

# Re-delivered copies: every 20th offset arrives again later, with a new price.
DUP_EVERY = 20
DUP_OFFSET_SHIFT = 1_000_000_000
# Every 97th offset is truncated to its first 20 characters in the JSON form.
MALFORMED_EVERY = 97
MALFORMED_KEEP = 20


def _q(name: str, dialect: str) -> str:
    if name == "timestamp":
        return "`timestamp`" if dialect == "spark" else '"timestamp"'
    return name


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _raw_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = events(spark, sf_dir).select(
        *[F.expr(sp).alias(n) for n, sp, _ in _INNER]
    )
    return x.select(*[F.expr(e).alias(n) for n, e in RAW_COLUMNS])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-event view with its re-delivered copies (27 columns).

    One scan: every row whose offset is a multiple of ``DUP_EVERY`` is
    emitted twice by an ``explode``, the second time as the re-delivery.
    """
    base = _raw_once(spark, sf_dir)
    copies = F.when(F.col("kafka_offset") % DUP_EVERY == 0, F.array(F.lit(False), F.lit(True))) \
        .otherwise(F.array(F.lit(False)))
    dup = F.col("_redelivered")
    return (
        base.withColumn("_redelivered", F.explode(copies))
        .withColumns({
            "price": F.when(dup, (F.col("price") + 1).cast("decimal(18,2)")).otherwise(F.col("price")),
            "kafka_offset": F.when(dup, F.col("kafka_offset") + F.lit(DUP_OFFSET_SHIFT))
                             .otherwise(F.col("kafka_offset")),
            "kafka_timestamp": F.when(dup, F.col("kafka_timestamp") + F.expr("interval 1 minute"))
                                .otherwise(F.col("kafka_timestamp")),
        })
        .drop("_redelivered")
    )


def fixture_batch_id() -> Column:
    """Batch number of a raw row: day of month minus one (0..29 on the data)."""
    return (F.dayofmonth("kafka_timestamp") - 1).cast("int")


def fixture_committed_at() -> Column:
    """Commit time of a batch: midnight after its day."""
    return F.date_trunc("day", F.col("kafka_timestamp")) + F.expr("interval 1 day")


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-style records: envelope columns plus the payload as JSON text."""
    raw = raw_events(spark, sf_dir)
    js = F.to_json(F.struct(*[F.col(c) for c in PAYLOAD_FIELDS]))
    value = F.when(F.col("kafka_offset") % MALFORMED_EVERY == 0,
                   F.substring(js, 1, MALFORMED_KEEP)).otherwise(js)
    return raw.select(
        F.col("kafka_key").alias("key"),
        value.alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


# ---------------------------------------------------------------- DuckDB text

def raw_events_sql() -> str:
    """The same view as DuckDB SQL, over the pre-registered ``events`` view."""
    inner = ",\n    ".join(f"{dk or sp} AS {n}" for n, sp, dk in _INNER)
    cols = ",\n  ".join(f"{e} AS {_q(n, 'duckdb')}" for n, e in RAW_COLUMNS)
    base = f"SELECT\n  {cols}\nFROM (SELECT\n    {inner}\n  FROM events) x"
    names = ", ".join(_q(n, "duckdb") for n, _ in RAW_COLUMNS)
    dup_sel = ", ".join(
        {
            "price": "cast(price + 1 AS decimal(18,2)) AS price",
            "kafka_offset": f"kafka_offset + {DUP_OFFSET_SHIFT} AS kafka_offset",
            "kafka_timestamp": "kafka_timestamp + INTERVAL 1 MINUTE AS kafka_timestamp",
        }.get(n, _q(n, "duckdb"))
        for n, _ in RAW_COLUMNS
    )
    return (
        f"(WITH raw_base AS ({base})\n"
        f" SELECT {names} FROM raw_base\n"
        f" UNION ALL\n"
        f" SELECT {dup_sel} FROM raw_base WHERE kafka_offset % {DUP_EVERY} = 0)"
    )


BATCH_ID_SQL = "cast(date_part('day', kafka_timestamp) - 1 AS integer)"
COMMITTED_AT_SQL = "date_trunc('day', kafka_timestamp) + INTERVAL 1 DAY"


def raw_json_sql() -> str:
    payload = ", ".join(f"{_q(n, 'duckdb')} := {_q(n, 'duckdb')}" for n in PAYLOAD_FIELDS)
    js = f"cast(to_json(struct_pack({payload})) AS varchar)"
    return (
        f"(SELECT kafka_key AS key,\n"
        f"  CASE WHEN kafka_offset % {MALFORMED_EVERY} = 0 THEN substring({js}, 1, {MALFORMED_KEEP})"
        f" ELSE {js} END AS value,\n"
        f"  kafka_topic AS topic, kafka_partition AS \"partition\", kafka_offset AS \"offset\","
        f" kafka_timestamp AS \"timestamp\"\n"
        f" FROM {raw_events_sql()} r)"
    )
