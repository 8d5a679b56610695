"""Projection operators: declared schemas, lineage stamps, safe arithmetic and ordered flag ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the fields of ``schema``: extras dropped, missing ones null, types cast."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def stamped(df: DataFrame, **lineage) -> DataFrame:
    """Constant lineage columns (source, algorithm, version, unit ...)."""
    return df.withColumns({k: F.lit(v) for k, v in lineage.items()})


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is null, zero or negative."""
    return F.when(whole > 0, part / whole)


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def ladder(*steps: tuple[Column, object], otherwise: object) -> Column:
    """The value of the first step whose condition holds; the order of the steps is part of the meaning."""
    out = None
    for condition, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def city_code(code: Column) -> Column:
    """City code of a six-digit district code."""
    return F.concat(F.substring(code, 1, 4), F.lit("00"))


def coverage_flag(pixels: Column, area: Column, ratio: Column) -> Column:
    """Quality of a zonal row: empty, then sliver, then coverage to review, else pass."""
    return ladder((pixels == 0, "empty"), (area < 900, "sliver"), (~ratio.between(0.8, 1.2), "review"), otherwise="pass")


def near_full(area: Column, full: float = 1e6, tolerance: float = 0.01) -> Column:
    """``full`` where the area is within ``tolerance`` of it."""
    return F.when(F.abs(area - full) <= tolerance, F.lit(full)).otherwise(area)
