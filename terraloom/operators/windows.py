"""Ranking and ordered operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<c>_norm``: (x - min) / (max - min) over all rows, 0 where the range is 0. The extremes are one
    aggregated row, joined back, so no window gathers the table in one task."""
    ends = df.agg(*[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(ends))
    for c in columns:
        span = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        out = out.withColumn(f"{c}_norm", F.when(span > 0, (F.col(c) - F.col(f"_lo_{c}")) / span).otherwise(0.0))
    return out.drop(*[f"_lo_{c}" for c in columns], *[f"_hi_{c}" for c in columns])


def delta(value: str, by: str, *order: str) -> Column:
    return F.col(value) - F.lag(value).over(Window.partitionBy(by).orderBy(*order))


def backfilled(value: str, change: str, by: str, *order: str) -> Column:
    """A missing level is the next level less the next change."""
    w = Window.partitionBy(by).orderBy(*order)
    return F.coalesce(F.col(value), F.lead(value).over(w) - F.lead(change).over(w))


def sticky(value: Column, by: str, *order: str) -> Column:
    """The last value that was not null, so far."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def ambiguous(df: DataFrame, by: str, score: str, margin: float) -> DataFrame:
    """Per group the best score, the runner-up and whether it is closer than ``margin``."""
    w = Window.partitionBy(by).orderBy(F.desc(score))
    top = df.withColumn("_r", F.row_number().over(w)).withColumn("runner_up", F.lead(score).over(w)).where("_r = 1")
    return top.select(by, F.col(score).alias("best"), "runner_up", F.coalesce(F.col(score) - F.col("runner_up") < margin, F.lit(False)).alias("ambiguous"))


def allocate(demand: Column, capacity: Column, by: str, *order: str) -> tuple[Column, Column]:
    """(allocated, remaining) when demands draw on a capacity in order: what is left of it, at most the demand."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum(demand).over(w) - demand
    got = F.greatest(F.lit(0), F.least(demand, capacity - before))
    return got, F.greatest(F.lit(0), capacity - before - got)


def top_k(df: DataFrame, by: str, k: int, *order: Column) -> DataFrame:
    return df.withColumn("rk", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rk") <= k)
