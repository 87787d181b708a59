"""Hilbert order, zone maps, payload drift, batch states of reports."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import drift, quality, sketches, skipping
from tidepool.sources import ingest


@pytest.mark.parametrize(("dims", "bits"), [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_once_and_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = skipping.hilbert_index(cells, bits)
    assert sorted(place.tolist()) == list(range(1 << (bits * dims)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_map_reads_few_files_and_exact_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).selectExpr("id", "cast(id * 7919 % 1000 AS int) AS a", "concat('u', id * 104729 % 5000) AS u",
                                        "CASE WHEN id % 3 = 0 THEN NULL ELSE cast(id * 31 % 777 AS int) END AS b")
    df.write.parquet(f"{path}_in")
    skipping.hilbert(spark.read.parquet(f"{path}_in"), ["a", "b"], 32).write.parquet(path)
    table = spark.read.parquet(path)
    assert table.exceptAll(df).count() == 0 and table.count() == 20_000
    zones = skipping.zone_map(table, ["a", "b"], ["u"]).cache()
    assert zones.count() == 32 and zones.agg(F.sum("rows")).first()[0] == 20_000
    for equal, between, most in (({"a": 17}, {}, 16), ({}, {"a": (100, 150)}, 16), ({}, {"b": (0, 40)}, 24), ({"u": "u42"}, {}, 20), ({"a": -5}, {}, 0),
                                 ({"u": "nobody"}, {"a": (0, 999)}, 12), ({}, {"a": (10, 60), "b": (10, 60)}, 10)):
        got, opened = skipping.read(spark, path, zones, equal, between)
        want = df
        for c, v in equal.items():
            want = want.filter(F.col(c) == v)
        for c, (lo, hi) in between.items():
            want = want.filter(F.col(c).between(lo, hi))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and opened <= most, (equal, between, opened)


def test_drift_report_and_clean_rows(spark):
    rows = ['{"event_id":"1","event_type":"page_view","timestamp":"2024-01-01T00:00:00Z","price":1.5}',
            '{"event_id":"2","event_type":"page_view","timestamp":"2024-01-01T00:00:00Z","price":"1.5","tier":{"a":[1]},"ok":true}',
            '{"event_id":3,"event_type":null,"tier":"gold","properties":{"x":"y"}}', "not json", "[1,2]", None, "{}"]
    df = spark.createDataFrame([("k", v, "t", 0, i, None) for i, v in enumerate(rows)], ingest.RECORD_SCHEMA)
    got = {(r["field"], r["seen_type"].split("<")[0]): (r["declared_type"], r["status"], r["rows"]) for r in drift.report(df).collect()}
    assert got["event_id", "STRING"] == ("string", "expected", 2) and got["event_id", "BIGINT"] == ("string", "retyped", 1)
    assert got["price", "STRING"] == ("decimal(18,2)", "retyped", 1) and [v for k, v in got.items() if k[0] == "price" and k[1] != "STRING"][0][1:] == ("expected", 1)
    assert got["tier", "OBJECT"] == (None, "unknown", 1) == got["tier", "STRING"] and got["ok", "BOOLEAN"] == (None, "unknown", 1)
    assert got["properties", "OBJECT"][1] == "expected" and ("event_type", "VOID") not in got
    rest = {r["offset"]: r["rest"] for r in df.select("offset", drift.unknown_fields(F.col("value")).alias("rest")).collect()}
    assert rest[1] == {"tier": '{"a":[1]}', "ok": "true"} and rest[2] == {"tier": "gold"} and all(rest[i] is None for i in (0, 3, 5, 6))
    plain = spark.createDataFrame([("k", rows[0], "t", 0, 0, None)], ingest.RECORD_SCHEMA)
    more = plain.withColumn("value", F.expr("""concat(substring(value, 1, length(value) - 1), ',"tier":"gold"}')"""))
    assert ingest.parse_records(plain, with_ingest_time=False).collect() == ingest.parse_records(more, with_ingest_time=False).collect()
    assert "tier" in drift.merged_type(df.filter("offset < 2")).first()[0] and drift.report(df.limit(0)).count() == 0


def test_reports_from_batch_states(spark):
    df = spark.range(6000).selectExpr("id % 7 AS batch", "CASE WHEN id % 10 = 0 THEN NULL ELSE id % 4000 END AS k", "cast(id AS double) AS x")
    rules = [quality.not_null("k", threshold=0.95), quality.unique("k", threshold=0.5), quality.in_range("x", 0, 2999), quality.not_null("missing")]
    whole = {r["check"]: r for r in quality.validate(df, rules).collect()}
    for by in ([], ["batch"]):
        merged = {r["check"]: r for r in quality.report(quality.batch_state(df, rules, by), rules).collect()}
        for name in ("not_null_k", "range_x"):
            assert merged[name].asDict() == whole[name].asDict()
        assert abs(merged["unique_k"]["actual"] - whole["unique_k"]["actual"]) <= 0.01 and merged["unique_k"]["passed"] == whole["unique_k"]["passed"]
        assert not merged["not_null_missing"]["passed"] and merged["not_null_missing"]["error"]
    nothing = {r["check"]: r["actual"] for r in quality.report(quality.batch_state(df.limit(0), rules[:3]), rules[:3]).collect()}
    assert set(nothing.values()) == {1.0}


def test_sketch_bounds_beyond_their_exact_size(spark):
    purchases = spark.range(200_000).selectExpr("'purchase' AS event_type", "cast(id % 9973 AS decimal(18,2)) AS total_amount", "cast(id AS string) AS event_id",
                                                "concat('2024-01-', lpad(cast(id % 28 + 1 AS string), 2, '0')) AS event_date", "'c' AS category", "'ch' AS channel_group", "'co' AS country")
    mart = sketches.order_value_mart(purchases, ["event_date", "category", "channel_group", "country"])
    got = sketches.median_rollup(mart, "monthly", quantiles=(0.1, 0.5, 0.99)).first()
    for q in (0.1, 0.5, 0.99):
        rank = purchases.filter(F.col("total_amount") <= got[f"q{round(100 * q)}"]).count() / 200_000
        assert abs(rank - q) <= sketches.RANK_ERROR
    users = spark.range(60_000).selectExpr("concat('u', id) AS user_id", "explode(slice(array('page_view', 'add_to_cart', 'checkout', 'purchase'), 1, cast(1 + id % 4 AS int))) AS event_type",
                                           "concat('2024-01-0', id % 9 + 1) AS event_date", "'x' AS channel_group", "'d' AS device_type")
    r = sketches.funnel_rollup(sketches.funnel_sketch_mart(users)).first()
    for name, exact in (("stage_1_viewers", 60_000), ("stage_2_cart_adders", 45_000), ("stage_4_purchasers", 15_000), ("kept_2", 45_000), ("kept_4", 15_000)):
        assert abs(r[name] - exact) <= 0.05 * 60_000
    products = spark.range(30_000).selectExpr("cast(id AS string) AS product_id", "'n' AS product_name", "'c' AS category",
                                              "cast(CASE WHEN id < 25 THEN 40000 - 400 * id ELSE id % 10 END AS decimal(38,2)) AS total_revenue", "explode(array('d1', 'd2')) AS event_date")
    top = sketches.top_products(sketches.revenue_cells(products), sketches.candidates(products), 20).collect()
    assert [int(t["product_id"]) for t in sorted(top, key=lambda t: t["rank"])] == list(range(20))
    assert all(0 <= t["revenue_estimate"] - 2 * (40000 - 400 * int(t["product_id"])) <= t["error_bound"] for t in top)
