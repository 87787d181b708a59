"""Session helpers.

The library never creates a session on its own: callers pass one in.
``local_session`` is for tests, the bench and the driver contract only.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Settings the operators rely on for deterministic results.
REQUIRED_CONF = {
    # event_date / event_hour are derived from timestamps.
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: partition coalescing, skew-join split,
    # broadcast only after the build side's size is measured.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidepool") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEPOOL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python workers import this package by name
        .config("spark.executorEnv.PYTHONPATH", PACKAGE_ROOT)
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder (below the warehouse where that is unset, as in tests)."""
    base = checkpoint_dir(spark, spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests) is ``fallback``
    installed and returned.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is unset and no fallback was given")
    sc.setCheckpointDir(fallback)
    return fallback
