"""Exact KPIs in update mode against the batch query, after every trigger."""

import datetime as dt
import decimal
import random

import pandas as pd
from pyspark.sql import functions as F

from tidepool.operators import marts, refine
from tidepool.streaming import exact_kpis as K
from tidepool.streaming import streams as P

ONCE = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1, 10, 0)


def _events(spark, rows):
    """(id, minute, user, type, price, offset)"""
    schema = P.log_schema(spark)
    base = {f.name: None for f in schema.fields}
    data = [dict(base, event_id=i, event_type=et, user_id=user, event_timestamp=T0 + dt.timedelta(minutes=m), kafka_timestamp=T0 + dt.timedelta(minutes=m),
                 kafka_offset=o, total_amount=None if p is None else decimal.Decimal(p), is_deleted=False, generation=0, batch_id=0) for i, m, user, et, p, o in rows]
    return spark.createDataFrame(data, schema)


def _run(q):
    assert q.awaitTermination(600) and q.exception() is None, q.exception()
    return q


def _bag(df):
    return sorted(tuple(r) for r in df.select("window_start", "window_end", "event_type", "event_count", "active_users", "window_revenue").collect())


def test_equal_to_the_batch_after_every_trigger_and_late_rows_are_kept(spark, tmp_path):
    src, out, late, ck = (str(tmp_path / n) for n in ("src", "out", "late", "ck"))
    batches = [
        [(f"a{m}", m, f"u{m % 3}", "page_view", None, m) for m in range(12)] + [(f"p{m}", m, "u1", "purchase", 5, m) for m in range(0, 12, 4)],
        # the same users again, a user without id, a re-delivery with another price, and one from before its first
        [(f"b{m}", m + 0.5, f"u{m % 4}" if m % 5 else None, "page_view", None, 100 + m) for m in range(8, 15)] + [("p8", 8, "u1", "purchase", 9, 200), ("p4", 4, "u1", "purchase", 7, 3)],
        [(f"c{m}", m, "u2", "purchase", 3, 300 + m) for m in range(40, 44)],
    ]
    done = []
    for n, rows in enumerate(batches):
        _events(spark, rows).write.parquet(f"{src}/batch_id={n}")
        _run(K.exact_kpi_stream(spark, src, out, late, ck, ONCE))
        done += rows
        want = marts.kpi_windows(refine.dedup_latest(_events(spark, done)))
        assert _bag(K.exact_kpis(spark, out)) == _bag(want)
        assert K.late_rows(spark, late).count() == 0
    # the watermark is now at 33 minutes: one row is late for all of its windows, one for some
    tardy = [("late1", 1, "u9", "page_view", None, 900), ("late2", 30.5, "u9", "page_view", None, 901)]
    _events(spark, tardy).write.parquet(f"{src}/batch_id=9")
    before = _bag(K.exact_kpis(spark, out))
    q = _run(K.exact_kpi_stream(spark, src, out, late, ck, ONCE))
    got = sorted((r["event_id"], r["window_end"]) for r in K.late_rows(spark, late).collect())
    mark = T0 + dt.timedelta(minutes=33)
    want = sorted((r["event_id"], r["window_end"]) for r in K.window_rows(_events(spark, tardy)).filter(F.col("window_end") <= F.lit(mark)).collect())
    assert got == want and len(got) == 5 + 3
    after = _bag(K.exact_kpis(spark, out))
    assert set(before) <= set(after) and len(after) == len(before) + 2
    assert q.lastProgress is not None
    # state of windows that have closed is gone
    assert sum(o.numRowsTotal for p in q.recentProgress[-1:] for o in p.stateOperators) < 200


def test_a_retried_trigger_changes_nothing(spark, tmp_path):
    src, out, late, ck = (str(tmp_path / n) for n in ("src", "out", "late", "ck"))
    _events(spark, [(f"a{m}", m % 7, f"u{m % 3}", "page_view", None, m) for m in range(30)]).repartition(5).write.parquet(f"{src}/batch_id=0")
    _run(K.exact_kpi_stream(spark, src, out, late, ck, ONCE, max_files_per_trigger=1))
    first = _bag(K.exact_kpis(spark, out))
    _run(K.exact_kpi_stream(spark, src, out, late, ck, ONCE))
    assert _bag(K.exact_kpis(spark, out)) == first


class _Calls:
    """Stands for a state variable: its content, and how often it was called."""

    def __init__(self, calls):
        self.calls, self.held, self.value = calls, {}, None

    def containsKey(self, key):
        self.calls.append("containsKey")
        return key in self.held

    def getValue(self, key):
        self.calls.append("getValue")
        return self.held[key]

    def updateValue(self, key, value):
        self.calls.append("updateValue")
        self.held[key] = value

    def removeKey(self, key):
        self.calls.append("removeKey")
        self.held.pop(key, None)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    def __init__(self, calls):
        self.calls = calls

    def getMapState(self, *_):
        return _Calls(self.calls)

    getValueState = getMapState

    def registerTimer(self, _):
        pass


class _Mark:
    def getCurrentWatermarkInMs(self):
        return -1


def test_few_state_calls_and_the_same_totals_however_many_events_are_held(monkeypatch):
    rng = random.Random(5)
    rows = [(f"e{rng.randrange(300)}", rng.choice(["u1", "u2", "u3", "u4", None]), decimal.Decimal(rng.randrange(9)), pd.Timestamp(T0) + pd.Timedelta(rng.randrange(50), "min"), o)
            for o in range(2_000)]
    last = {}
    for r in rows:
        if r[0] not in last or last[r[0]][3:] < r[3:]:
            last[r[0]] = r
    want = (len(last), len({r[1] for r in last.values()} - {None}), sum(r[2] for r in last.values()))
    key = (T0, T0 + dt.timedelta(days=1), "purchase", 0)
    for held in (100_000, 50, 1):
        monkeypatch.setattr(K, "HELD", held)
        calls, users = [], K.WindowUsers()
        users.init(_Handle(calls))
        for lo, hi in ((0, 1_500), (1_500, 2_000)):          # two triggers
            table = pd.DataFrame(rows[lo:hi], columns=["event_id", "user_id", "amount", "kafka_timestamp", "kafka_offset"])
            got = [r for part in users.handleInputRows(key, iter([table[:700], table[700:]]), _Mark()) for r in part.itertuples()]
            if held == 100_000 and not lo:
                # one write an event and one a user, no read of a key that has nothing stored
                assert len(calls) <= len({r[0] for r in rows[:hi]}) + 4 and set(calls) == {"updateValue"}
        assert (got[0].event_count, got[0].active_users, got[0].window_revenue) == want == users.totals.get()
        assert {k[0]: (v[0], v[3]) for k, v in users.events.held.items()} == {i: (r[1], r[4]) for i, r in last.items()}
