"""Every registered query against its independent DuckDB oracle.

Runs at sf0.001 to keep the suite quick; tools/oracle_check.py runs the
same comparison at any scale factor (the driver uses sf0.01).
"""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidepool.plans import catalog, oracle
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_exact_query_has_an_oracle():
    assert set(oracle.queries()) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(want_cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def _as_text(df):
    """Row multiset of a pandas frame, columns sorted, values as text; all NULL kinds alike."""
    import collections

    import pandas as pd
    df = df[sorted(df.columns)]

    def txt(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return str(v)
    return collections.Counter(tuple(txt(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_pandas_representation_matches_oracle(spark, duck, name):
    # the same values reach pandas the same way from both engines (dtype-level parity)
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert _as_text(got) == _as_text(want)
