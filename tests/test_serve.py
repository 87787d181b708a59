"""Serving queries beyond the oracle set: mart-served roll-up, range checks."""

import pytest

from tests.conftest import SF_SMALL
from tidepool.operators import marts, serve
from tidepool.plans import catalog

RANGE = ("2024-01-01", "2024-12-31")


@pytest.mark.parametrize("granularity,dims", [
    ("hourly", {"category": "electronics", "channel": "Paid Search"}),
    ("daily", {"country": "us"}),
    ("monthly", {}),
])
def test_rollup_from_mart_equals_clean_query(spark, granularity, dims):
    clean = catalog.clean(spark, SF_SMALL)
    mart = marts.revenue_mart(clean, buyers_sketch=True)
    got = serve.revenue_rollup(mart, *RANGE, granularity=granularity, **dims, limit=1000)
    want = serve.revenue_query(clean, *RANGE, granularity=granularity, **dims, limit=1000)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_limits_are_range_checked(spark):
    clean = catalog.clean(spark, SF_SMALL)
    with pytest.raises(ValueError):
        serve.revenue_query(clean, *RANGE, limit=0)
    with pytest.raises(ValueError):
        serve.top_products(marts.product_mart(clean), *RANGE, top_n=101)


def test_latest_kpis_at_given_time(spark):
    clean = catalog.clean(spark, SF_SMALL)
    row = serve.latest_kpis(clean, now="2024-01-15 12:00:00", minutes=60).first()
    n = clean.filter("event_timestamp > timestamp_ntz'2024-01-15 11:00:00' AND "
                     "event_timestamp <= timestamp_ntz'2024-01-15 12:00:00'").count()
    assert row["events_per_second"] == n / 3600.0
