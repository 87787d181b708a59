"""Batch sinks."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import sinks
from tidepool.plans import catalog
from tidepool.sources import ingest


def test_append_batch_returns_rows_and_evolves(spark, tmp_path):
    path = str(tmp_path / "bronze")
    b = catalog.bronze(spark, SF_SMALL).drop("ingestion_timestamp")
    old = b.filter(F.col("event_date") < "2024-01-15").drop("ip_address")
    new = b.filter(F.col("event_date") >= "2024-01-15")
    n1 = sinks.append_batch(old, path)
    n2 = sinks.append_batch(new, path)
    assert n1 + n2 == b.count()
    t = sinks.read_table(spark, path)
    assert t.count() == b.count()
    assert t.filter(F.col("ip_address").isNull()).count() == n1   # older schema reads NULL


def test_write_partitioned_replaces_from_the_least_date(spark, tmp_path):
    path = str(tmp_path / "mart")
    clean = catalog.clean(spark, SF_SMALL, keep_order=False).drop("silver_processed_at")
    n = sinks.write_partitioned(clean, path)
    assert n == clean.count()
    patch = clean.filter(F.col("event_date") == "2024-01-03").withColumn("quantity", F.lit(99))
    assert sinks.write_partitioned(patch, path) == patch.count()
    spark.catalog.refreshByPath(path)
    t = spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("string"))
    assert t.agg(F.max("event_date")).first()[0] == "2024-01-03"            # later dates are gone
    assert t.filter("event_date < '2024-01-03'").count() == clean.filter("event_date < '2024-01-03'").count()
    day = t.filter("event_date = '2024-01-03'")
    assert day.filter(F.col("quantity") != 99).count() == 0 and day.count() == patch.count()
    sinks.write_partitioned(patch.limit(0), path)
    assert spark.read.parquet(path).count() == t.count()


def test_a_failing_read_is_no_missing_table(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        sinks.write_partitioned(spark.range(3).withColumn("event_date", F.lit("2024-01-01")), str(path))
    assert (path / "part-0.parquet").read_text() == "not parquet"
    assert not sinks.table_exists(spark, str(tmp_path / "nowhere"))


def test_write_marts_counts(spark, tmp_path):
    clean = catalog.clean(spark, SF_SMALL)
    counts = sinks.write_marts(clean, str(tmp_path / "gold"))
    assert set(counts) == {"revenue_metrics", "session_analytics", "product_performance",
                           "funnel_analysis"}
    for name, n in counts.items():
        t = spark.read.parquet(str(tmp_path / "gold" / name))
        assert t.count() == n > 0 and "computed_at" in t.columns


def test_batch_id_format():
    assert re.fullmatch(r"bronze_\d{8}_\d{6}_[0-9a-f]{8}", ingest.new_batch_id())
