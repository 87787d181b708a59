"""Exact window KPIs in update mode, and the rows that came too late.

Spark's own aggregates allow an exact distinct count in update mode only through two chained stateful operators,
which update mode does not have. Here one ``transformWithState`` operator does it. Its state for a window, an event
type and a salt of the user:

* ``events`` (map): what each event id counted for, so a later delivery replaces an earlier one instead of adding (one
  that keeps the event's time, type and user, as re-deliveries do; otherwise it is an event of another key);
* ``users`` (map): how many events of the window each user has, so that users are counted once, exactly;
* ``totals`` (value): events, users and revenue so far.

After every trigger each changed (window, type, salt) gives its new totals; a reader adds the salts, whose users are
disjoint, so a busy window is many keys and never one task. An event-time timer drops a window's state once the
watermark has passed its end. A row that arrives after that is not dropped without a trace: the operator returns it
marked late, and the sink writes it to a table of late rows.

Each call to the state is a round trip to the JVM. A key's rows of a trigger are therefore folded in the worker first, at
most ``HELD`` events at a time: one write for each event and each user, and no reads for a key without stored events.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidepool.streaming import streams

SALTS = 8
HELD = 100_000             # events folded in a worker before they go to the state
LATE = "late"
KEY = ["window_start", "window_end", "event_type", "salt"]
OUTPUT = ("kind string, window_start timestamp, window_end timestamp, event_type string, salt int, event_count long, active_users long, "
          "window_revenue decimal(38,2), event_id string, user_id string, event_timestamp timestamp")
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


class WindowUsers(StatefulProcessor):
    """Events, distinct users and revenue of one (window, type, salt)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "event_id string", "user_id string, amount decimal(38,2), at timestamp, offset long")
        self.users = handle.getMapState("users", "user_id string", "n long")
        self.totals = handle.getValueState("totals", "events long, users long, revenue decimal(38,2)")

    def _rows(self, key, rows: pd.DataFrame, kind: str) -> pd.DataFrame:
        return rows.assign(kind=kind, **dict(zip(KEY, key, strict=True)))

    def _store(self, held: dict, moved: dict, known: bool) -> int:
        """Writes folded events, and moves the users' events of the window; returns how the number of users changes."""
        for i, (user, amount, at, offset) in held.items():
            self.events.updateValue((i,), (user, amount, at.to_pydatetime(), int(offset)))
        more = 0
        for user, step in moved.items():
            if user is None or not step:
                continue
            n = self.users.getValue((user,))[0] if known and self.users.containsKey((user,)) else 0
            if n + step:
                self.users.updateValue((user,), (n + step,))
            else:
                self.users.removeKey((user,))
            more += int(n == 0) - int(n + step == 0)
        return more

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = int(pd.Timestamp(key[1]).timestamp() * 1000)
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                late = part[["event_id", "user_id", "event_timestamp"]].assign(event_count=0, active_users=0, window_revenue=Decimal("0.00"))
                yield self._rows(key, late, LATE)[_NAMES]
            return
        events, users, revenue = self.totals.get() if self.totals.exists() else (0, 0, Decimal(0))
        if not events:
            self.handle.registerTimer(end)
        held, moved, known = {}, {}, events > 0
        for part in rows:
            for i, user, amount, at, offset in zip(part["event_id"], part["user_id"], part["amount"], part["kafka_timestamp"], part["kafka_offset"], strict=True):
                user = None if pd.isna(user) else user
                amount = Decimal(0) if amount is None or pd.isna(amount) else amount
                at = pd.Timestamp(at)
                was = held.get(i)
                if was is None and known and self.events.containsKey((i,)):
                    was = self.events.getValue((i,))
                if was is None:
                    events += 1
                elif (pd.Timestamp(was[2]), was[3]) >= (at, offset):
                    continue                                         # an older delivery
                else:
                    revenue -= was[1]
                    moved[was[0]] = moved.get(was[0], 0) - 1
                moved[user] = moved.get(user, 0) + 1
                revenue += amount
                held[i] = (user, amount, at, offset)
                if len(held) >= HELD:
                    users += self._store(held, moved, known)
                    held, moved, known = {}, {}, True
        users += self._store(held, moved, known)
        self.totals.update((events, users, revenue))
        now = pd.DataFrame({"event_count": [events], "active_users": [users], "window_revenue": [revenue], "event_id": [None], "user_id": [None],
                            "event_timestamp": [pd.NaT]})
        yield self._rows(key, now, "kpi")[_NAMES]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.events.clear()
        self.users.clear()
        self.totals.clear()
        return iter(())

    def close(self) -> None:
        pass


def window_rows(events: DataFrame, length: str = "5 minutes", slide: str = "1 minute", salts: int = SALTS) -> DataFrame:
    """One row for each window an event lies in, with the salt of its user."""
    at = F.col("event_timestamp").cast("timestamp")
    amount = F.when(F.col("event_type") == "purchase", F.col("total_amount")).otherwise(F.lit(0)).cast("decimal(38,2)")
    rows = events.select("event_id", "event_type", "user_id", at.alias("event_timestamp"), amount.alias("amount"),
                         F.col("kafka_timestamp").cast("timestamp").alias("kafka_timestamp"), F.col("kafka_offset").cast("long").alias("kafka_offset"),
                         *(["_event_time"] if "_event_time" in events.columns else []), F.window(at, length, slide).alias("window"))
    return rows.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end"),
                             "salt": F.pmod(F.xxhash64(F.coalesce("user_id", "event_id")), F.lit(salts)).cast("int")}).drop("window")


def changes(events: DataFrame, watermark: str = streams.WATERMARK, length: str = "5 minutes", slide: str = "1 minute",
            salts: int = SALTS) -> DataFrame:
    """The streaming plan: totals that changed in a trigger, and late rows, both told apart by ``kind``."""
    marked = events.withColumn("_event_time", F.col("event_timestamp").cast("timestamp")).withWatermark("_event_time", watermark)
    return window_rows(marked, length, slide, salts).drop("_event_time").groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=WindowUsers(), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def exact_kpi_stream(spark: SparkSession, log_path: str, path: str, late_path: str, checkpoint: str, trigger: dict | None = None,
                     watermark: str = streams.WATERMARK, max_files_per_trigger: int | None = None, salts: int = SALTS,
                     query_name: str = "exact_kpis") -> StreamingQuery:
    """KPIs of the change log in update mode: each trigger's totals to ``path/epoch=<n>``, its late rows to
    ``late_path/epoch=<n>`` (directories are overwritten, so a retried trigger changes nothing)."""
    streams.configure_streaming(spark)
    reader = spark.readStream.schema(streams.log_schema(spark)).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    live = reader.parquet(log_path).filter(~F.col("is_deleted"))

    return start(changes(live, watermark, salts=salts), path, late_path, checkpoint, trigger, query_name)


def start(changed: DataFrame, path: str, late_path: str, checkpoint: str, trigger: dict | None = None, query_name: str = "exact_kpis") -> StreamingQuery:
    """Writes what ``changes`` gives, trigger by trigger."""
    def write(df: DataFrame, epoch_id: int) -> None:
        # both kinds in one job (the operator runs once): the kind is the first directory
        df.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/epoch={epoch_id}")
        late = df.sparkSession.read.schema(OUTPUT).parquet(f"{path}/epoch={epoch_id}").filter(F.col("kind") == LATE)
        late.select("event_id", "event_type", "user_id", "event_timestamp", "window_start", "window_end").write.mode("overwrite").parquet(
            f"{late_path}/epoch={epoch_id}")

    w = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).queryName(query_name)
    return streams._with_trigger(w, trigger or streams.KPI_TRIGGER).start()


def exact_kpis(spark: SparkSession, path: str) -> DataFrame:
    """The KPI table now: latest totals of each (window, type, salt), salts added (their users are disjoint)."""
    rows = spark.read.schema(OUTPUT + ", epoch long").parquet(path).filter("kind = 'kpi'")
    last = rows.groupBy("window_start", "window_end", "event_type", "salt").agg(
        F.max_by(F.struct("event_count", "active_users", "window_revenue"), "epoch").alias("t"))
    return last.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                        "event_type").agg(F.sum("t.event_count").alias("event_count"), F.sum("t.active_users").alias("active_users"),
                                          F.sum("t.window_revenue").cast("double").alias("window_revenue"))


def late_rows(spark: SparkSession, late_path: str) -> DataFrame:
    """(event, window) pairs that came after the watermark had passed the window's end."""
    return spark.read.parquet(late_path).drop("epoch")
