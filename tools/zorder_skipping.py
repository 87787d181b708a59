"""Bytes and records the Parquet scan reads for a filter, before and after Z-order.

usage: python tools/zorder_skipping.py [sf_dir]
Writes the clean table twice into a scratch folder (16 files unordered, 16
files Z-ordered on (event_date, user_id)), runs point filters on both with
Spark's event log on, and sums the tasks' input metrics per query from the
log. Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import uuid
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidepool.operators import layout  # noqa: E402
from tidepool.plans import catalog  # noqa: E402
from tidepool.session import REQUIRED_CONF  # noqa: E402

FILTERS = {"user_id = user_7": ("user_id", "user_7"),
           "event_date = 2024-01-10": ("event_date", "2024-01-10")}


def _lines(path: str):
    """Event log lines; rolling logs may be compressed."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), "utf-8")
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    root = os.path.join(sys.argv[3] if len(sys.argv) > 3 else "spark-warehouse", f"zskip-{uuid.uuid4().hex}")
    os.makedirs(f"{root}/events")
    b = (SparkSession.builder.master("local[8]").appName("zorder-skipping")
         .config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"{root}/events"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    clean = catalog.clean(spark, sf_dir, keep_order=False).drop("silver_processed_at")
    clean.repartition(16).write.parquet(f"{root}/plain")
    layout.optimize(spark, f"{root}/plain", f"{root}/z", zorder_columns=["event_date", "user_id"],
                    num_files=16)
    for table in ("plain", "z"):
        for label, (col, value) in FILTERS.items():
            spark.sparkContext.setJobDescription(f"{table}|{label}")
            spark.read.parquet(f"{root}/{table}").filter(F.col(col) == value).write.format("noop") \
                .mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_desc, totals = {}, defaultdict(lambda: [0, 0])
    for path in glob.glob(f"{root}/events/**/events_*", recursive=True) + \
            glob.glob(f"{root}/events/*"):
        if os.path.isdir(path):
            continue
        for line in _lines(path):
            if True:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Input Metrics") or {}
                    t = totals[ev.get("Stage ID")]
                    t[0] += int(m.get("Bytes Read", 0))
                    t[1] += int(m.get("Records Read", 0))
    out = defaultdict(lambda: {"bytes_read": 0, "records_read": 0})
    for sid, (nbytes, nrec) in totals.items():
        desc = stage_desc.get(sid)
        if desc and "|" in desc:
            out[desc]["bytes_read"] += nbytes
            out[desc]["records_read"] += nrec
    print(json.dumps({"sf_dir": sf_dir, "files_per_table": 16, "scans": dict(out)}))


if __name__ == "__main__":
    main()
