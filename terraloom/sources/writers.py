"""Sinks: declared CSV, GeoJSON features, JSON reports, manifests and read-back checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terraloom.operators.projection import conform


def csv_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All-text rows for a CSV: declared order, booleans as true/false, lists joined by ``;``, null as blank."""
    typed = conform(df, schema)
    text = lambda f: F.array_join(f.name, ";") if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast("string")
    return typed.select(*[F.coalesce(text(f), F.lit("")).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, schema: T.StructType, bom: bool = True) -> None:
    """CSV with a header, lines ended by \\n; each file starts with a byte order mark, as part of its first column's name."""
    rows = csv_rows(df, schema)
    first = rows.columns[0]
    rows = rows.withColumnRenamed(first, "\ufeff" + first) if bom else rows
    rows.write.mode("overwrite").csv(path, header=True, lineSep="\n", emptyValue="", escape='"')


def features(df: DataFrame, properties: list[str], kind: str, coordinates: str) -> DataFrame:
    """GeoJSON features as text."""
    geometry = F.struct(F.lit(kind).alias("type"), F.col(coordinates).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))


def feature_collection(feature_rows: DataFrame, order: str) -> DataFrame:
    """One GeoJSON document of a bounded number of features (column ``value``), for layers that one file holds."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda x: x["value"])
    return feature_rows.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(texts, ","), F.lit("]}")).alias("value"))


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Moves a finished folder over ``target``: readers see the old one or the new one, never a part."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = path(target + "._old")
    if fs.exists(path(target)):
        fs.delete(old, True)
        fs.rename(path(target), old)
    if not fs.rename(path(source), path(target)):
        if fs.exists(old):
            fs.rename(old, path(target))
        raise OSError(f"{target} was not replaced")
    fs.delete(old, True)


def verified_write(df: DataFrame, path: str, key: str) -> DataFrame:
    """Writes Parquet beside ``path``, reads it back, and moves it there if both agree (else it raises): one row with
    both counts, both sums of the keys' hashes and whether they agree."""
    spark, beside = df.sparkSession, path + "._new"
    df.write.mode("overwrite").parquet(beside)
    stat = lambda d, p: d.agg(F.count("*").alias(f"{p}_rows"), F.coalesce(F.sum(F.xxhash64(key) % 1_000_003), F.lit(0)).alias(f"{p}_sum"))
    both = stat(df, "written").crossJoin(stat(spark.read.parquet(beside), "read"))
    both = both.withColumn("ok", (F.col("written_rows") == F.col("read_rows")) & (F.col("written_sum") == F.col("read_sum")))
    row = both.first()
    if not row.ok:
        raise OSError(f"{path}: what was read differs from what was written")
    replace_folder(spark, beside, path)
    return spark.createDataFrame([row], both.schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, files, size, sha256, sums) of the folders below ``root``, each file hashed where it is read: the SHA-256 of a
    folder is that of its files' lines in a SHA256SUMS file."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    f = f.where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")).select(F.element_at(F.split("path", "/"), -2).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("hash"))
    g = f.groupBy("path").agg(F.count("*").alias("files"), F.sum("size").alias("size"), F.array_sort(F.collect_list("hash")).alias("_h"))
    sums = F.array_join(F.transform("_h", lambda h: F.concat(h, F.lit("  "), F.col("path"))), "\n")
    return g.select("path", "files", "size", F.sha2(sums, 256).alias("sha256"), sums.alias("sums"))


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as one indented JSON document."""
    report.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def markdown_distribution(counts: DataFrame, title: str) -> DataFrame:
    """(line, text): a Markdown table of a distribution (value, n), most frequent first, then by value. Distributions have
    one row a value of an enumeration, so the numbering window is small."""
    head = counts.sparkSession.createDataFrame([(1, f"### {title}"), (2, ""), (3, "| value | count |"), (4, "| --- | ---: |")], "line long, text string")
    n = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("value")))
    return head.unionByName(counts.select((n + 4).cast("long").alias("line"), F.concat(F.lit("| "), F.regexp_replace("value", r"\|", r"\\\\|"), F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("text")))


def write_bands(raster: DataFrame, path: str, row: str, gate: int) -> DataFrame:
    """Writes a pixel table as one part, or, where it has more than ``gate`` pixels, as a north and a south part; gives the
    index (part, pixels, row_from, row_to) of what was written."""
    n, lo, hi = raster.agg(F.count("*"), F.min(row), F.max(row)).first()
    part = F.when(F.col(row) <= (lo + hi) // 2, "north").otherwise("south") if n > gate else F.lit("whole")
    raster.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(path)
    return raster.sparkSession.read.parquet(path).groupBy("part").agg(F.count("*").alias("pixels"), F.min(row).alias("row_from"), F.max(row).alias("row_to"))
