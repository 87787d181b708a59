"""Mixing with more sources than the period's usual slots."""

import collections

from tests.llm.conftest import frame
from tidepool.llm import mixing


def test_the_period_grows_with_the_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PERIOD", 8)
    monkeypatch.setattr(mixing, "BLOCK_CHARS", 40)
    data = [(i, "some words of a text " * (1 + i % 3), "en", f"s{i % 30}" if i % 3 else "hot") for i in range(400)] + [(1000, None, None, None)]
    plan = mixing.schedule(frame(spark, data)).collect()
    sources = {r["__source"] for r in plan}
    assert len(sources) == 22 and mixing.period_for(22) == 64 and mixing.period_for(8) == 8
    assert {r["__id"] for r in plan} == {d[0] for d in data}
    slots = collections.defaultdict(set)
    for r in plan:
        assert r["__release"] <= r["__slot"] < r["__deadline"]
        slots[r["__slot"]].add((r["__source"], r["__epoch"], r["__block"]))
    assert all(len(s) == 1 for s in slots.values())            # one block a slot
    given = collections.Counter(next(iter(s))[0] for t, s in slots.items() if t < 64)
    assert set(given) == sources and sum(given.values()) <= 64


def test_shares_of_many_sources():
    share = mixing.shares({f"s{i}": 1.0 + i for i in range(6000)}, mixing.period_for(6000))
    assert sum(share.values()) == 16_384 and min(share.values()) >= 1
    plan = mixing.period_schedule(share, 16_384)
    assert len(plan) == 16_384 and all(r <= t < d for _, _, r, d, t in plan)


def test_a_run_keeps_its_tables_in_its_folder(spark, tmp_path):
    import os

    from tidepool.llm import common
    spark.conf.set(common.RUN_FOLDER, str(tmp_path / "run"))
    try:
        assert common.settle(spark.range(5)).count() == 5
    finally:
        spark.conf.unset(common.RUN_FOLDER)
    assert len(os.listdir(tmp_path / "run")) == 1 and str(tmp_path) not in common.shared_folder(spark)
