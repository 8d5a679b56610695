"""Sources: declared CSV, GeoJSON, JSON lines, page texts, HTML lists, file inventories and archives."""

from __future__ import annotations

import contextlib
import hashlib
import io
import sqlite3
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window


def read_csv(spark: SparkSession, path: str, columns: list[str] | T.StructType, null_value: str = "") -> DataFrame:
    """CSV with header; a list of names reads them as strings, so codes keep their zeros."""
    schema = columns if isinstance(columns, T.StructType) else T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"', nullValue=null_value, enforceSchema=False)


def read_json(spark: SparkSession, path: str, lines: bool = True, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("multiLine", not lines)
    return (r.schema(schema) if schema else r).json(path)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: its properties, geometry type and coordinates as JSON text."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return f.select("f.properties", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def read_boxed(spark: SparkSession, path: str, box: tuple[float, float, float, float], columns: list[str]) -> DataFrame:
    """Parquet layer with xmin..ymax columns: the box filter and the columns reach the scan."""
    x0, y0, x1, y1 = box
    return spark.read.parquet(path).where((F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1)).select(*columns)


def pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, page, text) of form-feed separated texts; a blank last page goes."""
    parts = F.split(text, "\f")
    parts = F.when((F.size(parts) > 1) & (F.trim(F.element_at(parts, -1)) == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return df.select(key, F.posexplode(parts).alias("page", "text")).withColumn("page", F.col("page") + 1)


def numbered_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number, item) of lines that start with a number and a stop."""
    lines = df.select(key, F.explode(F.split(text, "\n")).alias("line")).where(F.col("line").rlike(r"^\s*[0-9]+[.．、]\s*.+"))
    p = r"^\s*([0-9]+)[.．、]\s*(.+?)\s*$"
    return lines.select(key, F.regexp_extract("line", p, 1).cast("int").alias("number"), F.regexp_extract("line", p, 2).alias("item"))


def html_items(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, section, item): list items with the last heading before them; scripts and styles never count."""
    bare = F.regexp_replace(html, r"(?s)<script\b.*?</script>|<style\b.*?</style>", " ")
    parts = df.select(key, F.posexplode(F.regexp_extract_all(bare, F.lit(r"(?s)<(?:h[1-6]|li)\b[^>]*>.*?</(?:h[1-6]|li)>"), F.lit(0))).alias("pos", "part"))
    head = F.when(F.col("part").rlike("^<h"), F.regexp_replace("part", "<[^>]*>", ""))
    sticky = F.last(head, ignorenulls=True).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("section", sticky).where(F.col("part").rlike("^<li")).select(key, "pos", "section", F.trim(F.regexp_replace("part", "<[^>]*>", "")).alias("item"))


def detected_type(head: Column, name: Column) -> Column:
    """File type by its first bytes, then by its extension."""
    h = F.hex(head)
    # fixed values: magic numbers
    kinds = (("25504446", "pdf"), ("504B0304", "zip"), ("D0CF11E0", "ole"), ("89504E47", "png"), ("FFD8FF", "jpeg"), ("49492A00", "tiff"), ("4D4D002A", "tiff"), ("53514C69746520666F726D6174203300", "sqlite"), ("50415231", "parquet"))
    out = None
    for magic, kind in kinds:
        out = F.when(h.startswith(magic), kind) if out is None else out.when(h.startswith(magic), kind)
    return out.otherwise(F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``: name, size, SHA-256, detected type and how many files have the same content."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    f = f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), detected_type(F.substring("content", 1, 16), F.col("path")).alias("type"))
    same = f.groupBy("sha256").agg(F.count("*").alias("copies"))
    return f.join(same, "sha256")


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """``zip_members_of`` the archives at ``path``."""
    return zip_members_of(spark.read.format("binaryFile").load(path).select("path", "content"))


def zip_members_of(archives: DataFrame) -> DataFrame:
    """(archive, member, size, sha256, safe, virtual_path, error) of ZIP archives (path, content); an archive that cannot
    be read, or whose content fails its check sums, has one row with an error."""
    names = ("archive", "member", "size", "sha256", "safe", "error")

    def members(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(c or b"")) as z:
                        rows += [(p, i.filename, i.file_size, hashlib.sha256(z.read(i)).hexdigest(), not (i.filename.startswith("/") or ".." in i.filename.split("/")), None) for i in z.infolist() if not i.is_dir()]
                except (zipfile.BadZipFile, zlib.error) as e:
                    rows.append((p, None, None, None, None, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()))], names)

    out = archives.select("path", "content").mapInArrow(members, "archive string, member string, size long, sha256 string, safe boolean, error string")
    return out.withColumn("virtual_path", F.concat(F.lit("/vsizip/"), F.col("archive"), F.lit("/"), F.col("member")))


def tile_archives(members: DataFrame) -> DataFrame:
    """(archive, dem, num, status): archives must hold exactly one member ending in _DEM.tif and one in _NUM.tif, all safe."""
    one = lambda end: F.min(F.when(F.col("member").endswith(end), F.col("member")))
    n = lambda end: F.count_if(F.col("member").endswith(end))
    g = members.groupBy("archive").agg(one("_DEM.tif").alias("dem"), one("_NUM.tif").alias("num"), n("_DEM.tif").alias("_d"), n("_NUM.tif").alias("_n"), F.bool_and(F.coalesce("safe", F.lit(False))).alias("_safe"))
    return g.select("archive", "dem", "num", F.when((F.col("_d") == 1) & (F.col("_n") == 1) & F.col("_safe"), "PASS").otherwise("FAIL").alias("status"))


def table_rows(df: DataFrame, key: str, text: str, columns: int) -> DataFrame:
    """(key, line, c1..): rows of a text table (cells parted by a tab or two blanks) with that many cells, the first all digits."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line", "_l"))
    cells = lines.select(key, "line", F.split(F.trim("_l"), r"\t|\s{2,}").alias("_c")).where((F.size("_c") == columns) & F.col("_c")[0].rlike("^[0-9]+$"))
    return cells.select(key, "line", *[F.col("_c")[i].alias(f"c{i + 1}") for i in range(columns)])


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_rows(df: DataFrame, key: str, content: str) -> DataFrame:
    """(key, table, row, cells, error) of the tables in word-processing packages; one that cannot be read has one row with an error."""
    kind = df.schema[key].dataType

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(c or b"")) as z:
                        body = ElementTree.fromstring(z.read("word/document.xml"))
                    for n, table in enumerate(body.iter(_W + "tbl")):
                        for i, row in enumerate(table.iter(_W + "tr")):
                            out.append((k, n, i, ["".join(t.text or "" for t in cell.iter(_W + "t")) for cell in row.iter(_W + "tc")], None))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                    out.append((k, None, None, None, str(e)))
            types = (to_arrow_type(kind), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], [key, "table", "row", "cells", "error"])

    return df.select(key, content).mapInArrow(rows, f"{key} {kind.simpleString()}, table int, row int, cells array<string>, error string")


def package_layers(df: DataFrame, key: str, content: str) -> DataFrame:
    """(key, layer, data_type, features) of GeoPackages: the catalogue table and a count of each layer, read in memory."""
    kind = df.schema[key].dataType

    def layers(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with contextlib.closing(sqlite3.connect(":memory:")) as db:
                    db.deserialize(c)
                    for name, data_type in db.execute("SELECT table_name, data_type FROM gpkg_contents ORDER BY table_name").fetchall():
                        quoted = name.replace('"', '""')
                        out.append((k, name, data_type, db.execute(f'SELECT count(*) FROM "{quoted}"').fetchone()[0]))
            types = (to_arrow_type(kind), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], [key, "layer", "data_type", "features"])

    return df.select(key, content).mapInArrow(layers, f"{key} {kind.simpleString()}, layer string, data_type string, features long")


def cached_requests(requests: DataFrame, cache: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(answered, to send): requests joined by fingerprint to *successful* answers; failures are asked again."""
    r = requests.withColumn("fingerprint", F.sha2(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]), 256))
    good = cache.where("status = 'ok'").select("fingerprint", "answer")
    return r.join(good, "fingerprint"), r.join(good, "fingerprint", "left_anti")
