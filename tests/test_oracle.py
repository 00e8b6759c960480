"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from rankflow.plans import oracle, registry

TABLES = ["customer", "part", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return v.item()
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = registry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(oracle.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_every_query_has_an_oracle_or_a_brute_force_test():
    assert set(registry.QUERIES) == set(oracle.ORACLE)
