"""Aggregates with explicit tie and order rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distribution(df: DataFrame, value: str, blank: str = "(blank)") -> DataFrame:
    """Counts by value, blanks named; (value, n)."""
    v = F.coalesce(F.nullif(F.trim(F.col(value).cast("string")), F.lit("")), F.lit(blank))
    return df.groupBy(v.alias("value")).agg(F.count("*").alias("n"))


def moments(x: Column) -> list[Column]:
    """count, mean, population deviation, minimum and maximum; partial sums combine on the map side."""
    return [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]


def within_ratio(x: Column, limit: float) -> Column:
    """Share of values at most ``limit``; null without values."""
    return F.avg(F.when(x <= limit, 1.0).when(x > limit, 0.0))


def most_frequent(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mode by group: highest count, then longest text, then smallest."""
    n = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(by).orderBy(F.desc("_n"), F.desc(F.length(value)), F.asc(value))
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(by, F.col(value).alias("mode"), F.col("_n").alias("n"))


def dominant(df: DataFrame, by: str, cls: str, count: str) -> DataFrame:
    """Class with the largest count, the lowest class on ties; none where all counts are 0."""
    w = Window.partitionBy(by).orderBy(F.desc(count), F.asc(cls))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(by, F.when(F.col(count) > 0, F.col(cls)).alias("dominant"), F.col(count).alias("count"))


def unique_join(seq: Column, value: Column, sep: str = ";") -> Column:
    """Distinct values in first-seen order, joined."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(seq.alias("s"), value.alias("v")))), lambda x: x["v"])
    return F.array_join(F.array_distinct(F.filter(ordered, lambda v: v.isNotNull() & (v != ""))), sep)


def by_priority(value: Column, order: list[str]) -> Column:
    """Value that comes first in ``order``; values outside come last, in their own order."""
    rank = F.coalesce(*[F.when(value == v, F.lit(i)) for i, v in enumerate(order)], F.lit(999))
    return F.min(F.struct(rank.alias("r"), value.alias("v")))["v"]


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.sum(w)


def wide_ratios(df: DataFrame, by: str, cls: str, values: list, prefix: str) -> DataFrame:
    """One column per class with the class's share of the group, as conditional sums in one pass."""
    return df.groupBy(by).agg(*[(F.sum(F.when(F.col(cls) == v, 1.0).otherwise(0.0)) / F.count("*")).alias(f"{prefix}{i}") for i, v in enumerate(values)])


def union_area(df: DataFrame, by: str) -> DataFrame:
    """(by, area): area of the union of each group's boxes (x0, y0, x1, y1).

    The x edges of a group cut it into slabs; each box is dealt to its slabs, the y intervals of a slab are merged by
    their running end. Slabs are separate keys, so a large group spreads over many tasks."""
    edges = df.select(by, F.explode(F.array("x0", "x1")).alias("lo")).distinct()
    slabs = edges.withColumn("hi", F.lead("lo").over(Window.partitionBy(by).orderBy("lo"))).where("hi > lo")
    w = Window.partitionBy(by, "lo").orderBy("y0", "y1")
    parts = df.where("x1 > x0 and y1 > y0").join(slabs, by).where((F.col("x0") <= F.col("lo")) & (F.col("hi") <= F.col("x1")))
    ends = F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0.0), F.col("y1") - F.greatest(F.col("y0"), F.coalesce(ends, F.col("y0"))))
    covered = parts.withColumn("_h", fresh).groupBy(by).agg(F.sum(F.col("_h") * (F.col("hi") - F.col("lo"))).alias("area"))
    return df.select(by).distinct().join(covered, by, "left").select(by, F.coalesce("area", F.lit(0.0)).alias("area"))
