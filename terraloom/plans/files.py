"""Plans of sources and sinks: tables are written to the shared folder by the sinks and read again by the sources."""

from __future__ import annotations

import io
import sqlite3
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.plans.domain import LATTICE, lattice
from terraloom.plans.registry import query
from terraloom.plans.text_geo import PTS, points
from terraloom.sources import readers as S
from terraloom.sources import writers as K
from terraloom.sources.shared import new_path

PERSON = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType()), T.StructField("active", T.BooleanType())])


def people(t):
    return t.supplier.select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("code"), F.concat(F.col("s_name"), F.lit(', "x"\ny')).alias("name"), F.col("s_acctbal").cast("double").alias("balance"), (F.col("s_acctbal") > 0).alias("active"))


def people_csv(t, bom=True):
    path = new_path(t.spark, "people")
    K.write_csv(people(t), path, PERSON, bom)
    return path


@query("src_03_csv_strings", "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS code, s_name || ', \"x\"' || chr(10) || 'y' AS name, CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS active FROM supplier")
def _(t):
    return S.read_csv(t.spark, people_csv(t), ["code", "name", "balance", "active"]).drop("balance")


@query("src_04_csv_typed", "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS code, s_acctbal::DOUBLE AS balance FROM supplier")
def _(t):
    return S.read_csv(t.spark, people_csv(t, False), PERSON).select("code", "balance")


@query("src_05_json_config", "SELECT r_regionkey, r_name, n_name FROM region JOIN nation ON n_regionkey = r_regionkey")
def _(t):
    nations = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("nations"))
    catalog = t.region.join(nations, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", "r_name", "nations")
    report = catalog.agg(F.lit("1.0").alias("version"), F.collect_list(F.struct("r_regionkey", "r_name", "nations")).alias("regions"))
    path = new_path(t.spark, "catalog")
    K.write_json_report(report, path)
    schema = T.StructType.fromDDL("version string, regions array<struct<r_regionkey:bigint,r_name:string,nations:array<string>>>")
    return S.read_json(t.spark, path, lines=False, schema=schema).select(F.explode("regions").alias("r")).select("r.r_regionkey", "r.r_name", F.explode("r.nations").alias("n_name"))


@query("src_06_json_lines", "SELECT event_id, event_type, value FROM events")
def _(t):
    path = new_path(t.spark, "events")
    t.events.select("event_id", "event_type", "value").write.json(path)
    return S.read_json(t.spark, path, schema=T.StructType.fromDDL("event_id bigint, event_type string, value double"))


@query("src_01_geojson_layer", "SELECT n_nationkey::VARCHAR AS code, n_name AS name, 'Point' AS geometry_type, '[' || n_nationkey || '.5,2.0]' AS coordinates FROM nation")
def _(t):
    path = new_path(t.spark, "layer")
    layer = t.nation.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.array(F.col("n_nationkey") + 0.5, F.lit(2.0)).alias("xy"))
    rows = K.features(layer, ["code", "name"], "Point", "xy").withColumn("code", F.get_json_object("value", "$.properties.code"))
    K.feature_collection(rows, "code").coalesce(1).write.text(path)
    return S.read_geojson(t.spark, path).select(F.col("properties")["code"].alias("code"), F.col("properties")["name"].alias("name"), "geometry_type", "coordinates")


@query("src_02_boxed_layer", f"WITH {PTS} SELECT vec_id, lon FROM p WHERE lon + 0.1 >= 108.2 AND lon <= 108.5 AND lat + 0.1 >= 23.5 AND lat <= 23.9")
def _(t):
    path = new_path(t.spark, "boxes")
    x, y = F.col("lon"), F.col("lat")
    points(t).select("vec_id", "lon", x.alias("xmin"), (x + 0.1).alias("xmax"), y.alias("ymin"), (y + 0.1).alias("ymax")).write.parquet(path)
    return S.read_boxed(t.spark, path, (108.2, 23.5, 108.5, 23.9), ["vec_id", "lon"])


@query("src_07_block_scan", f"WITH {LATTICE} SELECT floor(r / 16.0)::BIGINT AS block_row, floor(c / 16.0)::BIGINT AS block_col, count(v) AS n, min(v) AS low, max(v) AS high, sum(v) AS total FROM px GROUP BY ALL")
def _(t):
    px = lattice(t).withColumns({"block_row": F.floor(F.col("row") / 16), "block_col": F.floor(F.col("col") / 16)})
    return px.groupBy("block_row", "block_col").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("total"))


def archives(t):
    """An archive a nation, made where its row is: every third lacks a member, every fifth has a path that leaves it."""
    def pack(batches):
        for b in batches:
            out = []
            for k, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    z.writestr(("../" if k % 5 == 0 else "") + f"{name}_DEM.tif", f"dem {k}")
                    if k % 3:
                        z.writestr(f"{name}_NUM.tif", f"num {k}")
                out.append((f"{k}.zip", buf.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.binary())], ["path", "content"])

    return t.nation.select("n_nationkey", "n_name").mapInArrow(pack, "path string, content binary")


@query("src_08_zip_members", """WITH m AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN '../' ELSE '' END || n_name || '_DEM.tif' AS member, 'dem ' || n_nationkey AS body FROM nation UNION ALL SELECT n_nationkey, n_name || '_NUM.tif', 'num ' || n_nationkey FROM nation WHERE n_nationkey % 3 <> 0)
SELECT k || '.zip' AS archive, member, length(body) AS size, sha256(body) AS sha256, NOT starts_with(member, '..') AS safe FROM m""")
def _(t):
    return S.zip_members_of(archives(t)).select("archive", "member", "size", "sha256", "safe")


@query("src_08_tile_archives", "SELECT n_nationkey || '.zip' AS archive, CASE WHEN n_nationkey % 5 = 0 THEN '../' ELSE '' END || n_name || '_DEM.tif' AS dem, CASE WHEN n_nationkey % 3 <> 0 THEN n_name || '_NUM.tif' END AS num, CASE WHEN n_nationkey % 3 <> 0 AND n_nationkey % 5 <> 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM nation")
def _(t):
    return S.tile_archives(S.zip_members_of(archives(t)))


@query("src_09_virtual_path", "SELECT '/vsizip/' || n_nationkey || '.zip/' || CASE WHEN n_nationkey % 5 = 0 THEN '../' ELSE '' END || n_name || '_DEM.tif' AS virtual_path FROM nation")
def _(t):
    return S.zip_members_of(archives(t)).where(F.col("member").endswith("_DEM.tif")).select("virtual_path")


@query("src_10_table_rows", "SELECT s_suppkey, 1 AS line, s_suppkey::VARCHAR AS c1, s_name AS c2, 'x ' || s_nationkey AS c3 FROM supplier UNION ALL SELECT s_suppkey, 3, '7', 'two', 'cells of it' FROM supplier")
def _(t):
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("no  name  place\n"), k, F.lit("\t"), F.col("s_name"), F.lit("   x "), F.col("s_nationkey").cast("string"), F.lit("\n12  only two\n 7  two  cells of it \n"))
    return S.table_rows(t.supplier.select("s_suppkey", text.alias("text")), "s_suppkey", "text", 3)


@query("src_14_document_tables", "SELECT n_nationkey, 0 AS tbl, i::INT AS row, CASE WHEN i = 0 THEN 'no|name' ELSE n_nationkey || '|' || n_name END AS cells FROM nation, range(0, 2) r(i)")
def _(t):
    def pack(batches):
        ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
        row = lambda *c: "<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{x}</w:t></w:r></w:p></w:tc>" for x in c) + "</w:tr>"
        for b in batches:
            out = []
            for k, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    z.writestr("word/document.xml", f"<w:document {ns}><w:body><w:tbl>{row('no', 'name')}{row(k, name)}</w:tbl></w:body></w:document>")
                out.append(buf.getvalue())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["n_nationkey", "content"])

    kind = t.nation.schema["n_nationkey"].dataType.simpleString()
    docs = t.nation.select("n_nationkey", "n_name").mapInArrow(pack, f"n_nationkey {kind}, content binary")
    return S.docx_rows(docs, "n_nationkey", "content").select("n_nationkey", F.col("table").alias("tbl"), "row", F.array_join("cells", "|").alias("cells"))


@query("src_21_package_layers", "SELECT n_nationkey, layer, 'features' AS data_type, CASE WHEN layer = 'roads' THEN n_nationkey % 4 ELSE 2 END AS features FROM nation, (VALUES ('roads'), ('a \"b\"')) l(layer)")
def _(t):
    def pack(batches):
        for b in batches:
            out = []
            for k in b.column(0).to_pylist():
                db = sqlite3.connect(":memory:")
                db.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
                for name, n in (("roads", k % 4), ('a "b"', 2)):
                    quoted = name.replace('"', '""')
                    db.execute("INSERT INTO gpkg_contents VALUES (?, 'features')", (name,))
                    db.execute(f'CREATE TABLE "{quoted}" (fid INTEGER)')
                    db.executemany(f'INSERT INTO "{quoted}" VALUES (?)', [(i,) for i in range(n)])
                db.commit()
                out.append(db.serialize())
                db.close()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["n_nationkey", "content"])

    kind = t.nation.schema["n_nationkey"].dataType.simpleString()
    return S.package_layers(t.nation.select("n_nationkey").mapInArrow(pack, f"n_nationkey {kind}, content binary"), "n_nationkey", "content")


@query("snk_02_csv_bom", "SELECT count(*) AS lines, true AS marked, true AS bare_newlines FROM supplier")
def _(t):
    path = new_path(t.spark, "people")
    K.write_csv(people(t).withColumn("name", F.lit("n")), path, PERSON)
    f = t.spark.read.format("binaryFile").load(path).where("path LIKE '%.csv'").select("content", F.col("content").cast("string").alias("text"))
    lines = F.sum(F.size(F.split("text", "\n")) - 2)  # less the header, and what follows the last line end
    return f.agg(lines.alias("lines"), F.bool_and(F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("marked"), F.bool_and(~F.contains("text", F.lit("\r")) & F.endswith("text", F.lit("\n"))).alias("bare_newlines"))


@query("snk_04_replaced_layer", "SELECT count(*) AS written_rows, count(*) AS read_rows, true AS ok, (SELECT count(*) FROM supplier WHERE s_acctbal > 0) AS rows_after FROM customer")
def _(t):
    """A layer is written, then replaced twice; readers of the path see the last one only."""
    path = new_path(t.spark, "layer")
    K.verified_write(t.nation, path, "n_nationkey")
    first = K.verified_write(t.customer, path, "c_custkey")
    K.verified_write(t.supplier.where("s_acctbal > 0"), path, "s_suppkey")
    return first.crossJoin(t.spark.read.parquet(path).agg(F.count("*").alias("rows_after"))).select("written_rows", "read_rows", "ok", "rows_after")


@query("snk_05_raster_bands", f"WITH {LATTICE}, b AS (SELECT *, (min(r) OVER () + max(r) OVER ()) // 2 AS mid FROM px) SELECT CASE WHEN r <= mid THEN 'north' ELSE 'south' END AS part, count(*) AS pixels, min(r) AS row_from, max(r) AS row_to FROM b GROUP BY 1")
def _(t):
    return K.write_bands(lattice(t), new_path(t.spark, "raster"), "row", 100)


@query("snk_06_manifest", """WITH f AS (SELECT 'region' AS path, string_agg(r_name || chr(10), '' ORDER BY r_name) AS body FROM region UNION ALL SELECT 'nation', string_agg(n_name || chr(10), '' ORDER BY n_name) FROM nation)
SELECT path, 1::BIGINT AS files, length(body) AS size, sha256(sha256(body) || '  ' || path) AS sha256, sha256(body) || '  ' || path AS sums FROM f""")
def _(t):
    root = new_path(t.spark, "delivery")
    for name, column in (("region", "r_name"), ("nation", "n_name")):  # one small file each
        getattr(t, name).select(column).coalesce(1).sortWithinPartitions(column).write.option("lineSep", "\n").text(f"{root}/{name}")
    return K.manifest(t.spark, root)


STATUS_REPORT = """SELECT count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'PASS' ELSE 'FAIL' END AS status FROM orders"""


@query("snk_07_json_report", STATUS_REPORT)
def _(t):
    path = new_path(t.spark, "report")
    K.write_json_report(t.orders.agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.when(F.count("*") == F.countDistinct("o_orderkey"), "PASS").otherwise("FAIL").alias("status")), path)
    return S.read_json(t.spark, path, lines=False, schema=T.StructType.fromDDL("orders bigint, finished bigint, status string"))


@query("snk_08_markdown", """WITH d AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1) SELECT 4 + row_number() OVER (ORDER BY n DESC, v) AS line, '| ' || v || ' | ' || n || ' |' AS text FROM d
UNION ALL SELECT * FROM (VALUES (1, '### Status'), (2, ''), (3, '| value | count |'), (4, '| --- | ---: |')) h(line, text)""")
def _(t):
    return K.markdown_distribution(t.orders.groupBy(F.col("o_orderstatus").alias("value")).agg(F.count("*").alias("n")), "Status")


@query("va_12_read_back", """SELECT 'orders' AS "check", count(*)::DOUBLE AS observed, count(*)::DOUBLE AS expected, 'PASS' AS status FROM orders UNION ALL SELECT 'a lost file', count(*) FILTER (WHERE o_orderkey % 2 = 0)::DOUBLE, count(*)::DOUBLE, CASE WHEN count(*) FILTER (WHERE o_orderkey % 2 = 0) = count(*) THEN 'PASS' ELSE 'FAIL' END FROM orders""")
def _(t):
    """What a folder holds against what was to be written; the second folder lacks a part."""
    from terraloom.operators import validation as V

    n, out = t.orders.count(), []
    for name, rows in (("orders", t.orders), ("a lost file", t.orders.where("o_orderkey % 2 = 0"))):
        path = new_path(t.spark, "orders")
        rows.select("o_orderkey").write.parquet(path)
        out.append(V.row_count(t.spark.read.parquet(path), name, n))
    return V.ledger(*out)
