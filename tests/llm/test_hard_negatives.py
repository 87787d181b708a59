"""Hard negatives against every pair scored in whole numbers."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.llm import hard_negatives, queries


def brute(data, every=50, positives=5, negatives=3, low=50, high=95):
    """Rows (id, label, vector); an id stands for one row."""
    good = sorted({(i, la, tuple(math.floor(256 * x) for x in v)) for i, la, v in data
                   if i is not None and la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = set()
    for a, la, v in good:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, lb == la) for b, lb, w in good if b != a and len(w) == len(v))
        for p, b, _ in [s for s in scored if s[2]][:positives]:
            hard = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out |= {(a, b, i + 1, s[1], -p, -s[0]) for i, s in enumerate(hard)}
    return out


def result(df):
    return {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect()}


def table(spark, data, parts=4):
    return spark.createDataFrame([(i, la, v, "clash", "clash") for i, la, v in data],
                                 "vec_id long, label int, embedding array<double>, slot string, score string").repartition(parts)


def odd(dim=24, scale=1.0):
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(6, dim)) * 0.4
    data = [(i, int(rng.integers(3)), (scale * (centre[i % 6] + 0.4 * rng.normal(size=dim))).tolist()) for i in range(700)]
    data += [(1000 + i, i % 2, [scale * 0.5] * dim) for i in range(150)]                # ties
    data += [(2000, None, [scale] * dim), (2050, 1, None), (2100, 1, [None] * dim), (2150, 1, [float("nan")] * dim), (2200, 1, [float("inf")] * dim),
             (None, 1, [scale] * dim), (2250, 1, [scale] * 3), (2300, 1, []), (2301, 1, []), (2302, 2, []), (2350, 9, [0.0] * dim), (2351, 9, [0.0] * dim)]
    return data + data[:90]


@pytest.mark.parametrize(("dim", "scale"), [(24, 1.0), (64, 1.0), (130, 1.0), (8, 3e5), (4, 5e6)])
def test_odd_rows(spark, dim, scale):
    data = odd(dim, scale)
    want = brute(data)
    assert len(want) > 50
    assert result(hard_negatives.mine(table(spark, data), F.col("vec_id") % 50 == 0)) == want


def test_waves_blocks_and_hot_labels(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "WAVE", 24 * 8)
    data = [(i, 0 if i % 3 else la, v) for i, la, v in odd() if i is not None]
    assert result(hard_negatives.mine(table(spark, data), F.col("vec_id") % 50 == 0)) == brute(data)
    assert result(hard_negatives.mine(table(spark, data), F.col("vec_id") % 50 == 0, positives=2, negatives=7, low=10, high=99)) == brute(data, 50, 2, 7, 10, 99)


def test_empty_tables(spark):
    assert result(hard_negatives.mine(table(spark, odd()), F.lit(None).cast("boolean"))) == set()
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="int too|overflow|Overflow"):
        hard_negatives.mine(table(spark, [(0, 1, [1e12] * 4), (1, 1, [1e12] * 4), (2, 2, [7e11] * 4)]), F.col("vec_id") % 50 == 0).collect()


def test_intervals_always_hold_the_product():
    rng = np.random.default_rng(1)
    for dim in (3, 64, 100):
        v = np.floor(256 * np.concatenate([rng.normal(size=(300, dim)), np.ones((2, dim)), np.zeros((1, dim)), 1e4 * rng.normal(size=(20, dim))]))
        words, along, norm = hard_negatives.code(v)
        anchors = hard_negatives.Anchors(np.arange(len(v)), np.arange(len(v)), np.zeros(len(v)), v)
        low, high = anchors.intervals(words, along, norm)
        assert ((low <= v @ v.T) & (v @ v.T <= high)).all()
        assert (high - low).mean() < 1.7 * np.outer(norm, norm).mean()              # and is narrower than the trivial one (2)


def test_whole_table(spark):
    data = collections.deque()
    for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect():
        la = r["label"]
        data.append((r["vec_id"], (la + 1) % 10 if la is not None and r["vec_id"] % 7 == 0 else la, r["embedding"]))
    assert result(queries.op12_hard_negatives(spark, SF_SMALL)) == brute(data)
