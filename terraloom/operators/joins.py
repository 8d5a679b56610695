"""Join operators: checked one-to-one joins, densification, link status, blocked pairs and distance joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.sources.shared import new_path

#: Rows up to which a lookup side is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: Rows of a block in ``pairs_within``; a task compares about this many squared.
BLOCK_ROWS, MOST_TASKS = 1024, 10_000
#: Rows of a table that every row of another is compared with directly.
FEW = 64


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``rows`` rows and BROADCAST_BYTES as text (one bounded
    scan)."""
    width = F.sum(F.octet_length(F.to_csv(F.struct(*[F.col(c).cast("string") for c in df.columns]))))
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(width, F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that raises at run time if a key occurs twice on the right."""
    once = right.groupBy(key).agg(*[F.first(c).alias(c) for c in right.columns if c != key], F.count("*").alias("_n"))
    once = once.withColumn(key, F.when(F.assert_true(F.col("_n") == 1, F.lit("key is not unique")).isNull(), F.col(key)))
    return left.join(once.drop("_n"), key, "left")


def lookup(df: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Left lookup, null on a miss."""
    return df.join(sized(table), on, "left")


def filled(left: DataFrame, right: DataFrame, on: str, **defaults) -> DataFrame:
    """Left join with default values for missing measures."""
    return left.join(right, on, "left").fillna(defaults)


def densified(keys_a: DataFrame, keys_b: DataFrame, counts: DataFrame, on: list[str], measure: str) -> DataFrame:
    """Every combination of two key tables with its measure, 0 where there is none. The result has that many rows by
    definition; the second table is broadcast only if it is small."""
    return keys_a.crossJoin(sized(keys_b)).join(counts, on, "left").fillna({measure: 0})


def link_status(links: DataFrame, records: DataFrame, record: str, target: str) -> DataFrame:
    """(record, target, n, status): matched_single keeps its target, matched_multiple has none, else unmatched."""
    per = links.groupBy(record).agg(F.countDistinct(target).alias("n"), F.min(target).alias("_one"))
    j = records.select(record).join(per, record, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return j.select(record, F.when(F.col("n") == 1, F.col("_one")).alias(target), "n",
                    F.when(F.col("n") == 0, "unmatched").when(F.col("n") == 1, "matched_single").otherwise("matched_multiple").alias("status"))


def blocked_pairs(df: DataFrame, key: str, blocks: dict[str, Column]) -> DataFrame:
    """(left, right, reason): pairs of keys that agree on a block value, left < right, null and blank blocks apart."""
    out = None
    for reason, block in blocks.items():
        b = df.select(F.col(key), block.alias("_block")).where(F.col("_block").isNotNull() & (F.col("_block") != ""))
        a = b.withColumnRenamed(key, "left").join(b.withColumnRenamed(key, "right"), "_block").where("left < right").select("left", "right", F.lit(reason).alias("reason"))
        out = a if out is None else out.unionByName(a)
    return out


def pairs_within(df: DataFrame, key: str, row: str) -> DataFrame:
    """All pairs of rows that agree on ``key`` (never null), the smaller ``row`` on the left: columns l_<name> and
    r_<name>. The result is quadratic in a group by definition: groups are cut into blocks of about BLOCK_ROWS rows
    and pairs of blocks are dealt to the tasks, so one large group, or a table in one file, still uses them all."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_n"), (F.count("*").cast("double") ** 2).alias("_w"))
    tasks = max(1, min(MOST_TASKS, math.ceil((counts.agg(F.sum("_w")).first()[0] or 0) / BLOCK_ROWS**2)))
    cut = df.join(sized(counts.drop("_w")), key).withColumn("_own", F.pmod(F.xxhash64(row), F.col("_n"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    side = lambda mark, x, y: cut.select(F.col(key).alias("_key"), F.col(x).alias("_x"), F.col(y).alias("_y"), *[F.col(c).alias(f"{mark}_{c}") for c in df.columns]).repartition(tasks, "_key", "_x", "_y")
    pairs = side("l", "_own", "_other").hint("merge").join(side("r", "_other", "_own").hint("merge"), ["_key", "_x", "_y"])
    return pairs.where(F.col(f"l_{row}") < F.col(f"r_{row}")).drop("_key", "_x", "_y")


def cell_pairs(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Rows of ``a`` (ax, ay) with rows of ``b`` (bx, by) not farther than ``radius``: equi-join on grid cells of
    that size, ``b`` in its own and the eight cells around, then the exact distance ``dist``."""
    left = a.withColumns({"_cx": F.floor(F.col("ax") / radius), "_cy": F.floor(F.col("ay") / radius)})
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    right = (b.withColumn("_dx", F.explode(near)).withColumn("_dy", F.explode(near))
             .withColumns({"_cx": F.floor(F.col("bx") / radius) + F.col("_dx"), "_cy": F.floor(F.col("by") / radius) + F.col("_dy")}).drop("_dx", "_dy"))
    d = left.join(right, ["_cx", "_cy"]).withColumn("dist", F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")))
    return d.where(F.col("dist") <= radius).drop("_cx", "_cy")


def nearest(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Nearest row of ``b`` (bx, by) for each row of ``a`` (ax, ay); ties go to the smallest key. No ``b``, no rows.

    Rows are compared with all of ``b`` only if it has FEW rows. Else rings grow: within a radius at which a cell
    holds about one row of ``b`` the join on grid cells finds the nearest of most; the radius is doubled for the
    rest, until it spans everything. Each round is written to the shared folder."""
    best = lambda d: d.groupBy(a_key).agg(F.min(F.struct("dist", b_key)).alias("_m")).select(a_key, F.col(f"_m.{b_key}").alias(b_key), F.col("_m.dist").alias("dist"))
    side = b.select(b_key, "bx", "by")
    if side.limit(FEW + 1).count() <= FEW:
        return best(a.crossJoin(F.broadcast(side)).withColumn("dist", F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))))
    spark, lo_hi = a.sparkSession, lambda c: (F.min(c), F.max(c))
    n, x0, x1, y0, y1 = side.agg(F.count("*"), *lo_hi("bx"), *lo_hi("by")).first()
    u0, u1, v0, v1 = a.agg(*lo_hi("ax"), *lo_hi("ay")).first()
    if u0 is None:
        return best(a.crossJoin(side.limit(0)).withColumn("dist", F.lit(0.0)))
    whole = math.hypot(max(x1, u1) - min(x0, u0), max(y1, v1) - min(y0, v0)) * 1.01 + 1e-9
    radius = max(math.sqrt(max(x1 - x0, whole / n) * max(y1 - y0, whole / n) / n), whole / 2**20)
    left, out = a.select(a_key, "ax", "ay"), None
    while True:
        path = new_path(spark, "nearest")
        best(cell_pairs(left, side, radius)).write.parquet(path)
        done = spark.read.parquet(path)
        out = done if out is None else out.unionByName(done)
        left = left.join(done.select(a_key), a_key, "left_anti")
        if radius >= whole or not left.limit(1).count():
            return out
        radius = min(2 * radius, whole)


def seam(tiles: DataFrame, key: str, step: int, value: str) -> DataFrame:
    """Differences across neighbouring tiles: self equi-join on the key shifted by ``step``."""
    nxt = tiles.select((F.col(key) - step).alias(key), F.col(value).alias("next"))
    return tiles.join(nxt, key).withColumn("diff", F.abs(F.col("next") - F.col(value)))


def latest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """First row of each key in the given order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")
