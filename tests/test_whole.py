"""Plans without id limits handle the whole table (test_parity compares their rows with DuckDB)."""

import os

import pytest

from terraloom.plans import relational  # noqa: F401
from terraloom.plans.registry import QUERIES

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_mixed_sort_is_whole_and_in_order(spark):
    got = [(r.l_quantity, r.l_orderkey, r.l_linenumber) for r in QUERIES["so_01_mixed_sort"](spark, DATA).collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1], x[2]))
    assert len(got) == spark.read.parquet(f"{DATA}/lineitem.parquet").count()


def test_name_or_alias_is_whole(spark):
    supp = {r[0] for r in spark.read.parquet(f"{DATA}/supplier.parquet").select("s_suppkey").collect()}
    cust = [r[0] for r in spark.read.parquet(f"{DATA}/customer.parquet").select("c_custkey").collect()]
    want = sorted((c, c * 3 if c % 2 == 0 and c * 3 in supp else c if c in supp else None) for c in cust)
    assert sorted(map(tuple, QUERIES["jn_06_name_or_alias"](spark, DATA).collect())) == want
