"""Checks as DataFrames: each gives rows (check, observed, expected, status)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str, observed: Column, expected: Column, ok: Column) -> DataFrame:
    return df.agg(observed.alias("observed"), expected.alias("expected"), ok.alias("_ok")).select(
        F.lit(name).alias("check"), F.col("observed").cast("double"), F.col("expected").cast("double"), F.when(F.col("_ok"), "PASS").otherwise("FAIL").alias("status"))


def unique(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Rows beyond the first of each key; the keys are grouped, so nothing is gathered."""
    extra = df.groupBy(*keys).agg((F.count("*") - 1).alias("x"))
    s = F.coalesce(F.sum("x"), F.lit(0))
    return _row(extra, name, s, F.lit(0), s == 0)


def row_count(df: DataFrame, name: str, expected: int) -> DataFrame:
    return _row(df, name, F.count("*"), F.lit(expected), F.count("*") == expected)


def violations(df: DataFrame, name: str, bad: Column) -> DataFrame:
    n = F.count_if(bad)
    return _row(df, name, n, F.lit(0), n == 0)


def enumerated(df: DataFrame, name: str, column: str, values: list) -> DataFrame:
    return violations(df, name, ~F.col(column).isin(values))


def references(df: DataFrame, name: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose reference has no parent."""
    lost = df.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return _row(lost, name, F.count("*"), F.lit(0), F.count("*") == 0)


def conserved(parts: DataFrame, part: Column, wholes: DataFrame, whole: Column, name: str, tolerance: float) -> DataFrame:
    """Sum of the parts against the sum of the wholes."""
    both = parts.agg(F.sum(part).alias("p")).crossJoin(wholes.agg(F.sum(whole).alias("w")))
    return both.select(F.lit(name).alias("check"), F.col("p").cast("double").alias("observed"), F.col("w").cast("double").alias("expected"),
                       F.when(F.abs(F.col("p") - F.col("w")) <= tolerance, "PASS").otherwise("FAIL").alias("status"))


def ledger(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def reduced(checks: DataFrame) -> DataFrame:
    """FAIL if any check fails, WARN if any warns, else PASS; ready only on PASS."""
    worst = F.max(F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0))
    return checks.agg(F.count("*").alias("checks"), F.when(worst == 2, "FAIL").when(worst == 1, "WARN").otherwise("PASS").alias("status")).withColumn("ready", F.col("status") == "PASS")
