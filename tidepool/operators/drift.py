"""Payload drift: fields that the event schema does not know, or knows with another type.

``parse_records`` reads the declared fields and leaves the rest of a payload behind. Here the same JSON is also read as
a VARIANT, whose fields and types are whatever the sender wrote: ``report`` counts them against the declared schema, and
``unknown_fields`` keeps the fields the schema has no place for beside the parsed row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.sources.ingest import EVENT_SCHEMA

UNKNOWN, RETYPED, EXPECTED = "unknown", "retyped", "expected"


def _kind(declared: T.DataType) -> str:
    """The family of JSON values that a declared type reads without loss."""
    if isinstance(declared, (T.DecimalType, T.IntegerType, T.LongType, T.DoubleType)):
        return "number"
    if isinstance(declared, T.BooleanType):
        return "boolean"
    return "object" if isinstance(declared, (T.MapType, T.StructType)) else "array" if isinstance(declared, T.ArrayType) else "string"


def _seen_kind(seen: Column) -> Column:
    """The family of a variant's own type, as ``schema_of_variant`` names it."""
    return (F.when(seen.startswith("OBJECT"), "object").when(seen.startswith("ARRAY"), "array").when(seen == "STRING", "string")
            .when(seen == "BOOLEAN", "boolean").otherwise("number"))


def fields(records: DataFrame, value: str = "value") -> DataFrame:
    """(field, seen_type) of every top-level field of every payload that is a JSON object; JSON nulls are no fields."""
    parsed = records.select(F.try_parse_json(F.col(value).cast("string")).alias("_v"))
    entries = F.expr("try_variant_get(_v, '$', 'map<string, variant>')")
    return (parsed.filter("_v is not null").select(F.explode(entries).alias("field", "v"))
            .select("field", F.schema_of_variant("v").alias("seen_type")).filter("seen_type <> 'VOID'"))


def report(records: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """One row per field and type seen: ``declared_type`` (NULL where unknown), ``status`` and the rows that have it.

    The aggregate has one group a field and type, so it is partial before the shuffle, however many records there are.
    """
    known = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, f.dataType.simpleString())])
    kinds = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, _kind(f.dataType))])
    seen = fields(records, value).groupBy("field", "seen_type").agg(F.count(F.lit(1)).alias("rows"))
    status = (F.when(F.try_element_at(known, F.col("field")).isNull(), UNKNOWN)
              .when(F.try_element_at(kinds, F.col("field")) != _seen_kind(F.col("seen_type")), RETYPED).otherwise(EXPECTED))
    return seen.select("field", "seen_type", F.try_element_at(known, F.col("field")).alias("declared_type"), status.alias("status"), "rows")


def unknown_fields(value: Column, schema: T.StructType = EVENT_SCHEMA) -> Column:
    """The payload's fields that ``schema`` does not declare, as JSON text by name; NULL where there are none."""
    every = F.from_json(value.cast("string"), "map<string,string>")
    rest = F.map_filter(every, lambda k, _: ~k.isin([f.name for f in schema.fields]))
    return F.when(F.size(rest) > 0, rest)


def merged_type(records: DataFrame, value: str = "value") -> DataFrame:
    """One row: the type that all payloads together have (``schema_of_variant_agg``)."""
    return records.select(F.try_parse_json(F.col(value).cast("string")).alias("_v")).agg(F.schema_of_variant_agg("_v").alias("payload_type"))
