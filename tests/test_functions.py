"""Published values and invariants of functions without an SQL oracle."""

import heapq
import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from terraloom.functions import geo, text
from terraloom.operators import impact, ranking, raster, windows
from terraloom.sources import readers, writers


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_name_similarity(spark):
    pairs = [("甲粮库", "甲粮库"), ("南宁粮库", "南宁市粮库"), ("abc", "xbcy"), ("", "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(text.name_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[3] == 0.0
    assert abs(got[2] - SequenceMatcher(None, "abc", "xbcy").ratio()) < 1e-12


def test_nfkc_and_cleaning(spark):
    r = one(spark, text.clean_cell(F.lit("Ａ　b​ c")), text.nfkc(F.lit("ﬁ①")))
    assert r[0] == "Abc" and r[1] == "fi1"


def test_grid_id_keeps_long_and_negative_indexes(spark):
    r = one(spark, geo.grid_id(F.lit(-400500.0), F.lit(1234567890.0)))
    assert r[0] == "GX1K_R1234867_CN000001"


def test_datum_inverse_outside_is_identity(spark):
    u = one(spark, geo.unshifted(F.lit(10.0), F.lit(50.0)).alias("u")).u
    assert (u.lon, u.lat) == (10.0, 50.0)


def test_shortest_paths_against_dijkstra(spark):
    rng = random.Random(3)
    edges = [(f"n{a}", f"n{b}", rng.randint(1, 20) * 1.0) for a, b in {tuple(sorted(rng.sample(range(30), 2))) for _ in range(60)}]
    near = {}
    for u, v, w in edges:
        near.setdefault(u, []).append((v, w))
        near.setdefault(v, []).append((u, w))
    start = edges[0][0]
    dist, heap = {start: 0.0}, [(0.0, start)]
    while heap:
        d, u = heapq.heappop(heap)
        for v, w in near[u]:
            if d + w < dist.get(v, 1e9):
                dist[v] = d + w
                heapq.heappush(heap, (d + w, v))
    got = impact.shortest_paths(spark.createDataFrame(edges, "u string, v string, w double"), spark.createDataFrame([(1, start)], "case long, node string"))
    assert {r.node: r.dist for r in got.collect()} == dist


def test_horn_needs_nine_values(spark):
    px = spark.createDataFrame([(r, c, 3.0 * c if (r, c) != (3, 3) else None) for r in range(6) for c in range(6)], "row long, col long, value double")
    got = {(r.row, r.col): r.slope for r in raster.horn_slope(px, 3.0).collect()}
    assert got[(0, 0)] is None and got[(2, 2)] is None and abs(got[(1, 1)] - 45.0) < 1e-9


def test_global_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("x"))
    assert all(r.n == r.x + 1 for r in ranking.global_row_number(df, "n", F.asc("x")).collect())


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("﻿code,name\n007,\"x;\ny\"\n".encode())
    assert [tuple(r) for r in readers.read_csv(spark, str(p), ["code", "name"]).collect()] == [("007", "x;\ny")]
    (tmp_path / "g.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"a":"1"},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    assert readers.read_geojson(spark, str(tmp_path / "g.json")).first().geometry_type == "Point"
    assert writers.verified_write(spark.range(10), str(tmp_path / "out"), "id").first().ok
    (tmp_path / "b.zip").write_bytes(b"no archive")
    assert readers.zip_members(spark, str(tmp_path / "b.zip")).first().error


def test_published_values(spark):
    """Golden values: projection, datum inverse with its grid cell, stable id, allocation, back-fill."""
    x, y = geo.albers(F.lit(108.3208405), F.lit(22.8247514))
    r = one(spark, x.alias("x"), y.alias("y"))
    assert abs(r.x - 7093.031843) < 1e-3 and abs(r.y + 97257.867942) < 1e-3
    u = one(spark, geo.unshifted(F.lit(108.388866), F.lit(22.686831)).alias("u")).u
    assert (round(u.lon, 8), round(u.lat, 8)) == (108.38478154, 22.68953682)
    px, py = geo.albers(F.lit(u.lon), F.lit(u.lat))
    assert one(spark, geo.grid_id(px, py))[0] == "GX1K_R000187_C000413"
    assert one(spark, text.stable_id("cand", F.lit("name:南宁市储备粮管理有限责任公司五象粮库:physical_site")))[0] == "cand_88f87be3136e6cd7"
    shelter = spark.createDataFrame([("s", 1, 13321)], "shelter string, o int, need int")
    got, left = windows.allocate(F.col("need"), F.lit(200000), "shelter", "o")
    r = shelter.select(got.alias("got"), left.alias("left")).first()
    assert (r.got, r["left"]) == (13321, 186679)
    levels = spark.createDataFrame([("a", 1, None, None), ("a", 2, 76.863, 0.337)], "st string, d int, level double, change double")
    assert abs(levels.select(windows.backfilled("level", "change", "st", "d").alias("v"), "d").where("d = 1").first().v - 76.526) < 1e-9


def test_tied_ranks(spark):
    """Twelve districts of which eight have nothing share the last rank."""
    df = spark.createDataFrame([(i, *[float(max(0, 4 - i))] * 6) for i in range(12)], "k int, " + ", ".join(f"{c} double" for c in impact.WEIGHTS))
    assert [r["rank"] for r in impact.priority(df).orderBy("rank", "k").collect()] == [1, 2, 3, 4] + [5] * 8


def test_global_rank_shares_ties(spark):
    data = [(g, v) for g in ("a", "b", None) for v in (3.0, 1.0, 3.0, 2.0, None)]
    df = spark.createDataFrame(data * 3, "g string, v double")
    got = {(r.g, r.v): r.r for r in ranking.global_rank(df, "r", "g", "v").collect()}
    assert all(got[g, 3.0] == 1 and got[g, 2.0] == 7 and got[g, 1.0] == 10 and got[g, None] == 13 for g in ("a", "b", None))


def test_nearest_by_growing_rings(spark):
    import random

    from terraloom.operators import joins

    rng = random.Random(4)
    b = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(300)] + [(300, 500.0, 500.0), (301, 500.0, 500.0)]
    a = [(i, rng.gauss(0, 2), rng.gauss(0, 2)) for i in range(200)] + [(200, 900.0, 900.0), (201, -300.0, 0.0)]
    got = {r.a: (r.b, r.dist) for r in joins.nearest(spark.createDataFrame(a, "a long, ax double, ay double"), spark.createDataFrame(b, "b long, bx double, by double"), "a", "b").collect()}
    for i, x, y in a:
        d, k = min(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in b)
        assert got[i][0] == k and abs(got[i][1] - d**0.5) < 1e-9


def test_paths_longer_than_fifty_edges(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(60)], "u long, v long, w double")
    got = {r.node: r.dist for r in impact.shortest_paths(edges, spark.createDataFrame([(1, 0)], "case long, node long")).collect()}
    assert got[60] == 60.0


def test_replaced_folders_and_broken_packages(spark, tmp_path):
    p = str(tmp_path / "layer")
    for n in (5, 3):
        assert writers.verified_write(spark.range(n), p, "id").first().ok
    assert spark.read.parquet(p).count() == 3 and [x.name for x in tmp_path.iterdir()] == ["layer"]
    bad = spark.createDataFrame([("a", bytearray(b"no package"))], "path string, content binary")
    assert readers.zip_members_of(bad).first().error and readers.docx_rows(bad, "path", "content").first().error


def test_html_items_ignore_link_tags(spark):
    page = spark.createDataFrame([(1, "<head><link rel='x'></head><h1>Title</h1><ul><li>one</li></ul>")], "k long, html string")
    assert [(r.section, r.item) for r in readers.html_items(page, "k", "html").collect()] == [("Title", "one")]


def test_boxed_read_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id * 1.0D AS xmin", "id * 1.0D AS xmax", "0.0D AS ymin", "0.0D AS ymax", "'p' AS payload").write.parquet(str(tmp_path / "b"))
    df = readers.read_boxed(spark, str(tmp_path / "b"), (3, -1, 5, 1), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in df.collect()) == [3, 4, 5] and "GreaterThanOrEqual(xmax" in plan and "payload" not in plan


def test_geodesic_area_of_a_band(spark):
    """A whole degree square by the closed form of the area between parallels."""
    lons, lats = [F.lit(x) for x in (108.0, 108.02, 108.02, 108.0)], [F.lit(x) for x in (23.0, 23.0, 23.02, 23.02)]
    area = one(spark, geo.geodesic_area(lons, lats).alias("a")).a
    x = [geo.albers(a, b) for a, b in zip(lons, lats)]
    ring = F.array(*[F.struct(u.alias("x"), v.alias("y")) for u, v in [*x, x[0]]])
    assert abs(area / one(spark, geo.ring_area(ring).alias("a")).a - 1) < 1e-6
