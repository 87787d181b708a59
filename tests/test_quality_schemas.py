"""Quality reports and schema gates on a small frame of orders: one repeated row, one row about no item."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import quality as Q
from tidepool.operators import schemas

ORDERS = [("o1", "k1", "lamp", 3, "2023-05-01"), ("o2", "k1", "desk", 1, "2023-05-01"), ("o3", "k2", None, None, "2023-05-02"),
          ("o4", "9", "lamp", 12, "2023-05-03"), ("o1", "k1", "lamp", 3, "2023-05-01")]


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ORDERS, "order_id string, buyer string, item string, pieces int, day string")


def report(df, *rules):
    out = Q.validate(df, rules)
    return {r["check"]: r for r in out.collect()}, Q.summarize(out).first()


@pytest.mark.parametrize("rule, actual, passed", [
    (Q.not_null("order_id", Q.CRITICAL, 1.0), 1.0, True),
    (Q.not_null("item", Q.CRITICAL, 0.9), 0.8, False),
    (Q.unique("order_id", Q.WARNING, 0.8), 0.8, True),
    (Q.in_range("pieces", 1, 10), 0.6, False),
    (Q.in_range("buyer", 0, 10), 0.2, False),                       # text that is no number fails its rows only
    (Q.allowed_values("item", ["lamp", "desk"], Q.WARNING, 0.8), 0.8, True),
])
def test_each_rule(orders, rule, actual, passed):
    rows, _ = report(orders, rule)
    assert (rows[rule.name]["actual"], rows[rule.name]["passed"], rows[rule.name]["error"]) == (actual, passed, None)


def test_a_rule_of_ones_own(orders):
    rows, _ = report(orders, Q.expect("in_may", F.col("day").startswith("2023-05")), Q.expect("few", F.col("pieces") < 4))
    assert rows["in_may"]["passed"] and rows["few"]["actual"] == 0.6


@pytest.mark.parametrize("level, failed, warned, overall", [(Q.CRITICAL, 1, 0, False), (Q.WARNING, 0, 1, True), (Q.INFO, 0, 1, True)])
def test_levels_in_the_summary(orders, level, failed, warned, overall):
    _, top = report(orders, Q.not_null("item", level, 1.0), Q.not_null("day", level, 1.0))
    assert (top["checks_passed"], top["checks_failed"], top["checks_warned"], top["overall_pass"]) == (1, failed, warned, overall)


def test_rules_that_cannot_be_evaluated_become_rows(orders):
    rows, top = report(orders, Q.not_null("colour"), Q.expect("typo", F.col("peices") > 0), Q.not_null("order_id"))
    assert rows["not_null_colour"]["error"] == "column not found: colour" and not rows["not_null_colour"]["passed"]
    assert rows["typo"]["error"].startswith("not evaluable") and rows["not_null_order_id"]["passed"]
    assert (top["checks_failed"], top["checks_warned"], top["total_records"]) == (1, 0, 5)


def test_nothing_to_check_passes(orders):
    rows, _ = report(orders.limit(0), Q.not_null("item"), Q.unique("order_id"))
    assert {r["actual"] for r in rows.values()} == {1.0}


def test_nan_is_missing_in_numbers_only(spark):
    rows, _ = report(spark.createDataFrame([(float("nan"), "nan"), (2.5, None)], "x double, s string"), Q.not_null("x"), Q.not_null("s"))
    assert rows["not_null_x"]["actual"] == rows["not_null_s"]["actual"] == 0.5


def test_summary_names_its_layer(orders):
    row = Q.summarize(Q.validate(orders, [Q.not_null("day")]), layer="raw").first()
    assert row["layer"] == "raw" and row["timestamp"] is not None


def schema(**fields):
    return T.StructType([T.StructField(n, t, n.islower()) for n, t in fields.items()])     # capitals: required


@pytest.mark.parametrize("mode, gone, come", [("BACKWARD", 1, 1), ("FORWARD", 0, 1), ("FULL", 1, 1), ("NONE", 0, 0)])
def test_required_fields(mode, gone, come):
    small, large = schema(a=T.StringType()), schema(a=T.StringType(), B=T.IntegerType())
    assert len(schemas.compatibility_errors(large, small, mode)) == gone
    assert len(schemas.compatibility_errors(small, large, mode)) == come
    assert schemas.compatibility_errors(small, schema(a=T.StringType(), b=T.LongType()), mode) == []


@pytest.mark.parametrize("old, new, fits", [
    (T.IntegerType(), T.LongType(), True), (T.LongType(), T.DoubleType(), False), (T.TimestampNTZType(), T.TimestampType(), False),
    (T.IntegerType(), T.StringType(), False), (T.DecimalType(10, 2), T.DecimalType(12, 2), True), (T.DecimalType(10, 2), T.DecimalType(10, 4), False)])
def test_types_may_only_widen(old, new, fits):
    assert (schemas.compatibility_errors(schema(a=old), schema(a=new)) == []) == fits


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        schemas.compatibility_errors(schema(a=T.StringType()), schema(a=T.StringType()), "SIDEWAYS")


def test_gate(spark):
    declared = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.IntegerType())])
    table, none = schemas.gated_append(None, spark.createDataFrame([("a", 1)], declared), declared=declared)
    assert none is None
    lost, rejected = schemas.gated_append(table, spark.createDataFrame([(2,)], "n int"), declared=declared)
    assert lost is None and rejected.first()["error_reason"] == "id: required by the table, missing in the batch"
    lost, rejected = schemas.gated_append(table, spark.createDataFrame([("b", "oops")], "id string, n string"), declared=declared)
    assert lost is None and "does not widen" in rejected.first()["error_reason"]
    more, none = schemas.gated_append(table, spark.createDataFrame([("c", 3, "x")], "id string not null, n int, extra string"), declared=declared)
    assert none is None and sorted((r["id"], r["n"], r["extra"]) for r in more.collect()) == [("a", 1, None), ("c", 3, "x")]
