"""Driver contract: stable, unique column names; oracle keys match queries."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidepool.operators import quality as Q
from tidepool.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_schema_is_stable_and_names_unique(spark, name):
    a = E.queries()[name](spark, SF_SMALL).schema
    b = E.queries()[name](spark, SF_SMALL).schema
    assert a == b
    assert len(set(a.fieldNames())) == len(a.fieldNames())


def test_approximate_uniqueness_is_close(spark):
    bronze = catalog.bronze(spark, SF_SMALL)
    exact = {r["check"]: r["actual"] for r in Q.validate(bronze, [Q.unique("event_id")]).collect()}
    approx = {r["check"]: r["actual"] for r in
              Q.validate(bronze, [Q.unique("event_id", approx_rsd=0.01)]).collect()}
    assert abs(exact["unique_event_id"] - approx["unique_event_id"]) < 0.03
