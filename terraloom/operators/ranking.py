"""Ranks over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def global_row_number(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """1..n over all rows: range-partitioned sort, a number inside each partition, plus the rows before it
    (one count per partition). The order must be total for a stable result."""
    s = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    s = s.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    before = s.groupBy("_p").agg(F.count("*").alias("_n"))
    before = before.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    return s.join(F.broadcast(before), "_p").withColumn(name, F.col("_i") + F.col("_before")).drop("_p", "_i", "_before")


def global_rank(df: DataFrame, name: str, group: str, value: str) -> DataFrame:
    """Rank inside few large groups, highest ``value`` first, ties sharing a rank: the different values with their
    counts are numbered over a range-partitioned sort, so a group may fill many tasks."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("_c"))
    order = (F.col(group).asc_nulls_last(), F.col(value).desc_nulls_last())
    s = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    inside = Window.partitionBy("_p", group).orderBy(F.col(value).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_upto", F.sum("_c").over(inside))
    per = s.groupBy(F.col("_p").alias("_q"), F.col(group).alias("_h")).agg(F.sum("_c").alias("_n"))
    per = per.select("_q", "_h", (F.sum("_n").over(Window.partitionBy("_h").orderBy("_q")) - F.col("_n")).alias("_before"))
    s = s.select(F.col(group).alias("_g"), F.col(value).alias("_v"), "_c", "_p", "_upto")
    # one row a partition and group
    ranks = s.join(F.broadcast(per), (F.col("_p") == F.col("_q")) & F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "_v", (F.col("_upto") - F.col("_c") + F.col("_before") + 1).alias(name))
    return df.join(ranks, F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))).drop("_g", "_v")
