"""All pairs of names: ratios against difflib, blocks against brute force."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terraloom.functions import ratio, text
from terraloom.operators import joins


@pytest.mark.parametrize("letters,most", [("ab", 6), ("ab", 63), ("abc", 40), ("南宁市粮库有限公司😀", 20), ("0123456789#suplier", 18), ("xy", 230)])
@pytest.mark.parametrize("table", [8, 1 << 20])
def test_ratios_are_those_of_difflib(letters, most, table, monkeypatch):
    monkeypatch.setattr(ratio, "TABLE", table)
    rng = random.Random(most)
    a, b = (["", "", *("".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(40))] for _ in range(2))
    ia, ib = (np.array([rng.randrange(42) for _ in range(300)]) for _ in range(2))
    assert ratio.ratios(a, b, ia, ib).tolist() == [SequenceMatcher(None, a[i], b[j]).ratio() for i, j in zip(ia, ib)]


@pytest.mark.parametrize("block", [7, 1024])
def test_pairs_within_one_large_group(spark, tmp_path, block, monkeypatch):
    """A table in one file, most rows in one group: every pair once, and with small blocks in many tasks."""
    monkeypatch.setattr(joins, "BLOCK_ROWS", block)
    rows = [(i, f"Supplier#{i * 7919 % 1000:09d}" if i % 9 else None, None if i % 50 == 3 else 1 if i % 10 else i % 3) for i in range(150)] + [(None, "x", 1), (5, "y", 1)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    out = entry.queries()["st_19_name_similarity"](spark, str(tmp_path))
    got = sorted(out.collect())
    want = [(i, j, x, y) for i, x, m in rows for j, y, n in rows if None not in (i, j, m, n) and m == n and i < j]
    pairs = spark.createDataFrame(want, "a long, b long, x string, y string")
    match = [tuple(r) for r in pairs.select("a", "b", text.match_name(F.col("x")).alias("x"), text.match_name(F.col("y")).alias("y")).collect()]

    def similarity(x, y):
        r = SequenceMatcher(None, x, y).ratio()
        return 0.0 if not x or not y else 1.0 if x == y else max(r, min(len(x), len(y)) / max(len(x), len(y))) if x in y or y in x else r

    assert got == sorted((a, b, similarity(x, y)) for a, b, x, y in match)
    assert out.columns == ["a", "b", "similarity"] and (block > 7 or out.rdd.getNumPartitions() > 100)


def test_pairs_within_an_empty_table(spark):
    df = spark.createDataFrame([], "s_suppkey long, name string, s_nationkey int")
    assert joins.pairs_within(df, "s_nationkey", "s_suppkey").count() == 0
