"""Every registered plan with SQL agrees with DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from terraloom.plans import domain, extra, files, more, relational, text_geo  # noqa: F401
from terraloom.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if v == v else "nan"
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.9g}")
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(DATA):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{DATA}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_parity(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    a = sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=str)
    b = sorted((tuple(norm(r[columns.index(c)]) for c in order) for r in want.fetchall()), key=str)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0
