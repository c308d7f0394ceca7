"""Each query with oracle SQL gives the same rows as DuckDB on the small tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from genoframe.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _value(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
        return str(bool(v))
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return str(v)


def rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_value, r)) for r in frame.itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, duck):
    got = QUERIES[name](spark, DATA).toPandas()
    expected = duck.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(expected.columns)
    a, b = rows(got), rows(expected)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-5 * max(1, abs(q))) for p, q in zip(x, y, strict=True)), (x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark):
    frame = QUERIES[name](spark, DATA).toPandas()
    for column in frame.columns:
        if column == "p" or column.startswith("p_"):
            known = frame[column].dropna()
            assert ((known >= -1e-9) & (known <= 1 + 1e-9)).all()
