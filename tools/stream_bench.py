"""Streaming ingest throughput: JSON records -> bronze -> clean change log.

usage: python tools/stream_bench.py [sf_dir] [cpus] [scratch folder]
Writes the raw JSON records of the fixture to a scratch folder, then runs the
bronze stream and the clean foreachBatch stream with availableNow triggers.
Prints one JSON line with events/s for each stage.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import local_session  # noqa: E402
from tidepool.sources import fixtures as FX  # noqa: E402
from tidepool.sources import ingest  # noqa: E402
from tidepool.streaming import streams as P  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app="tidepool-stream-bench")
    root = os.path.join(sys.argv[3] if len(sys.argv) > 3 else "spark-warehouse", f"stream-bench-{uuid.uuid4().hex}")
    recs = FX.raw_json(spark, sf_dir)
    n = recs.count()
    recs.repartition(2 * cpus).write.parquet(f"{root}/records")
    once = {"availableNow": True}

    t0 = time.perf_counter()
    q = P.bronze_stream(ingest.file_record_stream(spark, f"{root}/records"), f"{root}/bronze",
                        f"{root}/ck/bronze", once)
    q.awaitTermination()
    t1 = time.perf_counter()
    q = P.clean_stream(spark, f"{root}/bronze", f"{root}/log", f"{root}/dlq", f"{root}/ck/clean",
                       f"{root}/metrics", once)
    q.awaitTermination()
    t2 = time.perf_counter()
    print(json.dumps({
        "records": n, "cpus": cpus, "sf_dir": sf_dir,
        "bronze_sec": round(t1 - t0, 2), "bronze_events_per_sec": round(n / (t1 - t0)),
        "clean_sec": round(t2 - t1, 2), "clean_events_per_sec": round(n / (t2 - t1)),
        "end_to_end_events_per_sec": round(n / (t2 - t0)),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
