"""Rasters as pixel tables (row, col, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mosaic(*tiles: tuple[DataFrame, int, int]) -> DataFrame:
    """Tiles placed at (row, col) offsets; where they overlap the first tile with a value wins."""
    out = None
    for i, (t, dr, dc) in enumerate(tiles):
        t = t.select((F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"), "value", F.lit(i).alias("_i")).where("value is not null")
        out = t if out is None else out.unionByName(t)
    return out.groupBy("row", "col").agg(F.min_by("value", "_i").alias("value"))


def masked(pixels: DataFrame, inside: DataFrame) -> DataFrame:
    """Values outside of the mask (row, col) become null."""
    m = inside.select("row", "col", F.lit(True).alias("_in"))
    return pixels.join(m, ["row", "col"], "left").select("row", "col", F.when(F.col("_in"), F.col("value")).alias("value"))


def horn_slope(pixels: DataFrame, cell: float) -> DataFrame:
    """(row, col, slope) in degrees by Horn's 3x3 weights; null unless all nine values are there.

    Each pixel is sent once to its nine targets with its share of the two gradients and summed there: one
    shuffle with map-side sums, no window over a whole row or column of the raster."""
    off = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]
    # a source at offset (dr, dc) from the target: east minus west, and south minus north, edges twice
    share = F.array(*[F.struct(F.lit(-dr).alias("dr"), F.lit(-dc).alias("dc"), F.lit(float(dc * (2 - abs(dr)))).alias("gx"), F.lit(float(dr * (2 - abs(dc)))).alias("gy")) for dr, dc in off])
    s = pixels.where("value is not null").withColumn("o", F.explode(share))
    g = s.groupBy((F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col")).agg(
        F.count("*").alias("n"), F.sum(F.col("value") * F.col("o.gx")).alias("gx"), F.sum(F.col("value") * F.col("o.gy")).alias("gy"))
    slope = F.degrees(F.atan(F.hypot(F.col("gx"), F.col("gy")) / (8 * cell)))
    return pixels.select("row", "col").join(g, ["row", "col"], "left").select("row", "col", F.when(F.col("n") == 9, slope).alias("slope"))


def resampled(pixels: DataFrame, target: DataFrame, bilinear: bool = True) -> DataFrame:
    """Values at fractional positions (id, r, c): bilinear over four neighbours (null if one is missing), or nearest."""
    if not bilinear:
        t = target.withColumn("row", F.floor(F.col("r") + 0.5)).withColumn("col", F.floor(F.col("c") + 0.5))
        return t.join(pixels, ["row", "col"], "left").select("id", "value")
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    t = target.withColumns({"r0": F.floor("r"), "c0": F.floor("c")}).withColumn("k", corner)
    fr, fc = F.col("r") - F.col("r0"), F.col("c") - F.col("c0")
    w = F.when(F.col("k.i") == 1, fr).otherwise(1 - fr) * F.when(F.col("k.j") == 1, fc).otherwise(1 - fc)
    t = t.withColumn("w", w).withColumn("row", F.col("r0") + F.col("k.i")).withColumn("col", F.col("c0") + F.col("k.j"))
    j = t.join(pixels, ["row", "col"], "left").groupBy("id").agg(F.sum(F.col("w") * F.col("value")).alias("v"), F.count("value").alias("n"))
    return j.select("id", F.when(F.col("n") == 4, F.col("v")).alias("value"))


def seam_selected(west: DataFrame, east: DataFrame, limit: int) -> DataFrame:
    """Columns below ``limit`` come from the west tile, the others from the east; there is no fallback."""
    return west.where(F.col("col") < limit).unionByName(east.where(F.col("col") >= limit))
