"""Further plans: spatial relations, projections compared, scoring ladders, manifests and dispatch details."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.functions import geo as G
from terraloom.functions import text as X
from terraloom.operators import aggregates as A
from terraloom.operators import joins as J
from terraloom.operators import projection as P
from terraloom.operators import raster as R
from terraloom.operators import resolve as E
from terraloom.operators import validation as V
from terraloom.operators import windows as W
from terraloom.plans.registry import query
from terraloom.plans.text_geo import PTS, points
from terraloom.sources import readers as S

# grid cells are parts, counties are suppliers, areas are quantities
REL = "rel AS (SELECT l_partkey AS cell, l_suppkey AS county, sum(l_quantity) AS area FROM lineitem GROUP BY ALL)"


def relation(t):
    return t.lineitem.groupBy(F.col("l_partkey").alias("cell"), F.col("l_suppkey").alias("county")).agg(F.sum("l_quantity").alias("area"))


@query("ge_04_cell_county_ratios", f"WITH {REL}, w AS (SELECT cell, sum(area) AS whole FROM rel GROUP BY 1) SELECT cell, county, area / 500 AS grid_ratio, area / whole AS land_ratio FROM rel JOIN w USING (cell)")
def _(t):
    r = relation(t)
    whole = r.groupBy("cell").agg(F.sum("area").alias("whole"))
    return r.join(whole, "cell").select("cell", "county", (F.col("area") / 500).alias("grid_ratio"), (F.col("area") / F.col("whole")).alias("land_ratio"))


@query("ge_05_primary_county", f"WITH {REL}, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY area DESC, county) AS r, area / sum(area) OVER (PARTITION BY cell) AS share FROM rel) SELECT cell, county AS primary_county, share FROM r WHERE r = 1")
def _(t):
    r = relation(t)
    best = r.groupBy("cell").agg(F.max_by(F.struct("county", "area"), F.struct("area", -F.col("county"))).alias("m"), F.sum("area").alias("whole"))
    return best.select("cell", F.col("m.county").alias("primary_county"), (F.col("m.area") / F.col("whole")).alias("share"))


BOXES = "b AS (SELECT n_nationkey AS k, n_nationkey * 3.0::DOUBLE AS x0, n_nationkey * 3.0::DOUBLE + 5 AS x1 FROM nation)"


def boxes(t):
    x = F.col("n_nationkey") * 3.0
    return t.nation.select(F.col("n_nationkey").alias("k"), x.alias("x0"), (x + 5).alias("x1"))


@query("jn_10_area_refined_join", f"WITH {BOXES}, c AS (SELECT i, i * 4.0::DOUBLE AS c0, i * 4.0::DOUBLE + 4 AS c1 FROM range(0, 25) r(i)) SELECT i AS cell, k, least(x1, c1) - greatest(x0, c0) AS area FROM b, c WHERE least(x1, c1) - greatest(x0, c0) > 1e-6")
def _(t):
    # every box is dealt to the cells that it covers, so the join is on a cell key and the area only refines
    b = boxes(t).withColumn("cell", F.explode(F.sequence(F.floor(F.col("x0") / 4), F.floor(F.col("x1") / 4)))).where("cell < 25")
    w = F.least(F.col("x1"), F.col("cell") * 4.0 + 4) - F.greatest(F.col("x0"), F.col("cell") * 4.0)
    return b.withColumn("area", w).where("area > 1e-6").select("cell", "k", "area")


@query("jn_11_self_overlap", f'WITH {BOXES} SELECT a.k AS "left", b.k AS "right", least(a.x1, b.x1) - greatest(a.x0, b.x0) AS overlap FROM b a JOIN b ON a.k < b.k AND least(a.x1, b.x1) - greatest(a.x0, b.x0) > 0')
def _(t):
    b = boxes(t).withColumn("cell", F.explode(F.sequence(F.floor(F.col("x0") / 4), F.floor(F.col("x1") / 4))))
    a = b.select("cell", F.col("k").alias("left"), F.col("x0").alias("a0"), F.col("x1").alias("a1"))
    j = a.join(b.withColumnRenamed("k", "right"), "cell").where("left < right").withColumn("overlap", F.least("a1", "x1") - F.greatest("a0", "x0"))
    return j.where("overlap > 0").select("left", "right", "overlap").distinct()


@query("jn_09_boundary_fallback", "SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey // 10 - 1 ELSE s_suppkey // 10 END AS cell FROM supplier")
def _(t):
    # strictly inside a cell first; a point on an edge takes the smallest cell that touches it
    x = F.col("s_suppkey") / 10
    inside = F.when(x != F.floor(x), F.floor(x))
    return t.supplier.select("s_suppkey", F.coalesce(inside, F.least(F.floor(x), F.floor(x) - 1)).cast("long").alias("cell"))


@query("jn_12_in_union", f"WITH {BOXES}, u AS (SELECT min(x0) AS lo, max(x1) AS hi FROM b WHERE k < 10) SELECT s_suppkey FROM supplier, u WHERE s_suppkey BETWEEN lo AND hi")
def _(t):
    u = boxes(t).where("k < 10").agg(F.min("x0").alias("lo"), F.max("x1").alias("hi"))
    return t.supplier.crossJoin(F.broadcast(u)).where("s_suppkey between lo and hi").select("s_suppkey")


@query("wn_04_tied_rank", "SELECT s_nationkey, sum(round(s_acctbal / 1000)) AS score, rank() OVER (ORDER BY sum(round(s_acctbal / 1000)) DESC)::INT AS rank FROM supplier GROUP BY 1")
def _(t):
    g = t.supplier.groupBy("s_nationkey").agg(F.sum(F.round(F.col("s_acctbal") / 1000)).alias("score"))
    return g.withColumn("rank", F.rank().over(Window.orderBy(F.desc("score"))))  # one row per nation


@query("wn_06_rank_sensitivity", """WITH s AS (SELECT s_suppkey, w, s_acctbal * w + s_nationkey * 100 AS score FROM supplier, (VALUES (0.8::DOUBLE), (1.0::DOUBLE), (1.2::DOUBLE)) v(w)), r AS (SELECT s_suppkey, rank() OVER (PARTITION BY w ORDER BY score DESC) AS r FROM s) SELECT s_suppkey, min(r)::INT AS rank_min, max(r)::INT AS rank_max FROM r GROUP BY 1""")
def _(t):
    s = t.supplier.withColumn("w", F.explode(F.array(F.lit(0.8), F.lit(1.0), F.lit(1.2)))).withColumn("score", F.col("s_acctbal") * F.col("w") + F.col("s_nationkey") * 100)
    return s.withColumn("r", F.rank().over(Window.partitionBy("w").orderBy(F.desc("score")))).groupBy("s_suppkey").agg(F.min("r").alias("rank_min"), F.max("r").alias("rank_max"))


@query("wn_15_route_length", "WITH p AS (SELECT o_custkey, o_orderkey, abs(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS step FROM orders) SELECT o_custkey, count(*) AS points, round(coalesce(sum(step), 0), 4) AS length FROM p GROUP BY 1")
def _(t):
    pts = t.orders.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))), lambda x: F.struct(x["o_totalprice"].alias("x"), F.lit(0.0).alias("y"))).alias("p"))
    return pts.select("o_custkey", F.size("p").cast("long").alias("points"), F.round(G.line_length(F.col("p")), 4).alias("length"))


@query("ge_11_geodesic_circle", f"WITH {PTS} SELECT vec_id, d AS bearing, true AS exact FROM p, (SELECT unnest(range(0, 360, 45)) AS d)")
def _(t):
    p = points(t).withColumn("bearing", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(315).cast("long"), F.lit(45).cast("long"))))
    lon, lat = G.destination(F.col("lon"), F.col("lat"), F.col("bearing"), F.lit(1000.0))
    a = F.pow(F.sin(F.radians(lat - F.col("lat")) / 2), 2) + F.cos(F.radians("lat")) * F.cos(F.radians(lat)) * F.pow(F.sin(F.radians(lon - F.col("lon")) / 2), 2)
    return p.select("vec_id", "bearing", (F.abs(2 * 6371008.8 * F.asin(F.sqrt(a)) - 1000) < 1e-3).alias("exact"))


@query("ge_14_projection_choice", "WITH c AS (SELECT s_suppkey AS id, 0.35 * (s_suppkey % 11) + 0.35 * (s_suppkey % 7) + 0.2 * (s_suppkey % 5) + 0.1 * (s_suppkey % 3) + CASE WHEN s_acctbal < 0 THEN 100 ELSE 0 END AS score, s_acctbal >= 0 AS eligible FROM supplier) SELECT id AS chosen, round(score, 6)::DOUBLE AS score FROM c WHERE eligible ORDER BY round(score, 9), id LIMIT 1")
def _(t):
    k = F.col("s_suppkey")
    c = t.supplier.select(k.alias("id"), (0.35 * (k % 11) + 0.35 * (k % 7) + 0.2 * (k % 5) + 0.1 * (k % 3) + F.when(F.col("s_acctbal") < 0, 100).otherwise(0)).alias("score"), (F.col("s_acctbal") >= 0).alias("ok"))
    return c.where("ok").agg(F.min(F.struct(F.round("score", 9).alias("s"), "id")).alias("m")).select(F.col("m.id").alias("chosen"), F.round("m.s", 6).alias("score"))


@query("ge_15_geometry_counts", "SELECT 5::BIGINT AS total, 1::BIGINT AS nulls, 1::BIGINT AS empty, 1::BIGINT AS open, 2::BIGINT AS valid")
def _(t):
    w = t.spark.createDataFrame([("LINESTRING(0 0, 1 0, 1 1, 0 0)",), ("LINESTRING(0 0, 2 0, 2 2, 0 0)",), ("LINESTRING(0 0, 1 0, 1 1)",), ("LINESTRING EMPTY",), (None,)], "wkt string")
    p = G.line_points(F.when(F.col("wkt").contains("EMPTY"), None).otherwise(F.col("wkt")))
    closed = F.coalesce((F.size(p) >= 4) & (F.element_at(p, 1) == F.element_at(p, -1)), F.lit(False))
    return w.agg(F.count("*").alias("total"), F.count_if(F.col("wkt").isNull()).alias("nulls"), F.count_if(F.col("wkt").contains("EMPTY")).alias("empty"), F.count_if(F.col("wkt").isNotNull() & ~F.col("wkt").contains("EMPTY") & ~closed).alias("open"), F.count_if(closed).alias("valid"))


@query("ge_21_admin_check", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'no_grid' WHEN s_suppkey % 4 = 1 THEN 'match' WHEN s_suppkey % 4 = 2 THEN 'county_differs' ELSE 'city_differs' END AS reason FROM supplier")
def _(t):
    k = F.col("s_suppkey") % 4
    counties = F.when(k == 0, None).otherwise(F.array(F.lit("c1"), F.lit("c2")))
    cities = F.array(F.lit("t1"))
    county, city = F.when(k == 2, "c9").otherwise("c1"), F.when(k == 3, "t9").otherwise("t1")
    return t.supplier.select("s_suppkey", P.ladder((counties.isNull(), "no_grid"), (~F.array_contains(counties, county), "county_differs"), (~F.array_contains(cities, city), "city_differs"), otherwise="match").alias("reason"))


@query("ge_23_flooded_share", "SELECT s_suppkey, greatest(least(s_suppkey % 20, 10), 0)::DOUBLE / 50 AS share, greatest(least(s_suppkey % 20, 10), 0)::DOUBLE / 50 >= 0.2 AS review FROM supplier")
def _(t):
    wet = G.box_overlap((0.0, 0.0, (F.col("s_suppkey") % 20).cast("double"), 1.0), (0.0, 0.0, 10.0, 1.0)) / 50
    return t.supplier.select("s_suppkey", wet.alias("share"), (wet >= 0.2).alias("review"))


@query("ra_06_slope_audit", "SELECT true AS agrees")
def _(t):
    # a plane has one slope everywhere: gradients 3 and 4 over cells of 10
    px = t.spark.range(400).select(F.floor(F.col("id") / 20).alias("row"), (F.col("id") % 20).alias("col")).withColumn("value", F.col("col") * 30.0 + F.col("row") * 40.0)
    want = F.degrees(F.atan(F.lit(5.0)))
    return R.horn_slope(px, 10.0).where("slope is not null").agg((F.max(F.abs(F.col("slope") - want)) < 1e-9).alias("agrees"))


@query("ra_11_palette", "SELECT n_nationkey, (['#000000', '#ff0000', '#00ff00'])[n_nationkey % 3 + 1] AS colour FROM nation")
def _(t):
    pal = t.spark.createDataFrame([(0, "#000000"), (1, "#ff0000"), (2, "#00ff00")], "code int, colour string")
    return J.lookup(t.nation.withColumn("code", F.col("n_nationkey") % 3), pal, "code").select("n_nationkey", "colour")


@query("er_05_duplicate_review", """WITH c AS (SELECT s_suppkey AS k, 'N' || s_suppkey % 40 AS name, s_nationkey AS code, s_suppkey % 2 AS kind FROM supplier), p AS (SELECT a.k AS "left", b.k AS "right", a.code = b.code AS same_code, a.name = b.name AS same_name, a.kind <> b.kind AS apart FROM c a JOIN c b ON a.k < b.k AND (a.code = b.code OR a.name = b.name))
SELECT "left", "right", concat_ws(';', CASE WHEN same_code THEN 'same_code' END, CASE WHEN same_name THEN 'same_name' END) AS reasons, CASE WHEN apart THEN 'keep_separate' ELSE 'manual_review' END AS action FROM p""")
def _(t):
    c = t.supplier.select(F.col("s_suppkey").alias("k"), F.concat(F.lit("N"), (F.col("s_suppkey") % 40).cast("string")).alias("name"), F.col("s_nationkey").cast("string").alias("code"), (F.col("s_suppkey") % 2).alias("kind"))
    pairs = J.blocked_pairs(c, "k", {"same_code": F.col("code"), "same_name": F.col("name")})
    p = pairs.groupBy("left", "right").agg(F.array_join(F.sort_array(F.collect_set("reason")), ";").alias("reasons"))
    kind = c.select("k", "kind")
    p = p.join(kind.toDF("left", "lk"), "left").join(kind.toDF("right", "rk"), "right")
    return p.select("left", "right", "reasons", F.when(F.col("lk") != F.col("rk"), "keep_separate").otherwise("manual_review").alias("action"))


@query("er_09_point_scoring", "WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 50 WHEN 1 THEN 40 WHEN 2 THEN 30 ELSE 15 END + CASE WHEN s_suppkey % 3 = 0 THEN 20 ELSE 0 END + CASE WHEN s_suppkey % 5 = 0 THEN 15 ELSE 0 END - CASE WHEN s_acctbal < 0 THEN 30 ELSE 0 END AS score, s_nationkey = 0 AS reject FROM supplier) SELECT s_suppkey, score::INT AS score, CASE WHEN reject THEN 'rejected' WHEN score >= 60 THEN 'accepted' ELSE 'review' END AS decision FROM s")
def _(t):
    k = F.col("s_suppkey")
    score = P.ladder((k % 4 == 0, 50), (k % 4 == 1, 40), (k % 4 == 2, 30), otherwise=15) + F.when(k % 3 == 0, 20).otherwise(0) + F.when(k % 5 == 0, 15).otherwise(0) - F.when(F.col("s_acctbal") < 0, 30).otherwise(0)
    s = t.supplier.withColumn("score", score)
    return s.select("s_suppkey", "score", P.ladder((F.col("s_nationkey") == 0, "rejected"), (F.col("score") >= 60, "accepted"), otherwise="review").alias("decision"))


@query("er_10_demotion", "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'demoted_parent_match' WHEN s_acctbal > 5000 THEN 'accepted' ELSE 'review' END AS decision FROM supplier")
def _(t):
    first = F.when(F.col("s_acctbal") > 5000, "accepted").otherwise("review")
    return t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") < 0, "demoted_parent_match").otherwise(first).alias("decision"))


@query("er_12_failure_priority", "SELECT o_custkey, arg_min(o_orderpriority, o_orderpriority) AS worst FROM orders GROUP BY 1")
def _(t):
    order = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return t.orders.groupBy("o_custkey").agg(A.by_priority(F.col("o_orderpriority"), order).alias("worst"))


@query("er_14_confirmation", "SELECT o_orderkey, o_custkey % 2 = 0 AND o_totalprice > 1000 AND o_orderstatus <> 'P' AS confirmed FROM orders")
def _(t):
    return t.orders.select("o_orderkey", ((F.col("o_custkey") % 2 == 0) & (F.col("o_totalprice") > 1000) & (F.col("o_orderstatus") != "P")).alias("confirmed"))


@query("va_11_manifest_check", "SELECT s_suppkey, s_suppkey % 6 <> 0 AS intact FROM supplier")
def _(t):
    have = t.supplier.select("s_suppkey", F.sha2("s_name", 256).alias("sha"))
    listed = have.select("s_suppkey", F.when(F.col("s_suppkey") % 6 == 0, F.sha2(F.lit("x"), 256)).otherwise(F.col("sha")).alias("expected"))
    return have.join(listed, "s_suppkey").select("s_suppkey", (F.col("sha") == F.col("expected")).alias("intact"))


@query("va_16_status_counts", "WITH l AS (SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) SELECT CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched_single' ELSE 'matched_multiple' END AS value, count(*) AS n FROM part LEFT JOIN l ON k = p_partkey GROUP BY 1")
def _(t):
    links = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
    return A.distribution(J.link_status(links, t.part.select(F.col("p_partkey").alias("part")), "part", "supp"), "status")


@query("di_07_rescue_case", "WITH d AS (SELECT c_custkey, s_suppkey, abs(c_acctbal - s_acctbal) AS straight, abs(c_acctbal - s_acctbal) * 1.3 + 20 + 30 AS total, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - s_acctbal), s_suppkey) AS r FROM customer, supplier WHERE s_acctbal >= 0) SELECT c_custkey, s_suppkey, straight, total FROM d WHERE r = 1")
def _(t):
    a = t.customer.select("c_custkey", F.col("c_acctbal").alias("ax"), F.lit(0.0).alias("ay"))
    b = t.supplier.where("s_acctbal >= 0").select("s_suppkey", F.col("s_acctbal").alias("bx"), F.lit(0.0).alias("by"))
    return J.nearest(a, b, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", F.col("dist").alias("straight"), (F.col("dist") * 1.3 + 20 + 30).alias("total"))


@query("di_15_stamps", "SELECT n_nationkey, 'E1' AS event_id, '2024-01-01' AS analysis_date, 'derived' AS data_type, '1.0' AS calculation_version FROM nation")
def _(t):
    return P.stamped(t.nation.select("n_nationkey"), event_id="E1", analysis_date="2024-01-01", data_type="derived", calculation_version="1.0")


@query("di_16_case_completion", "SELECT o_orderkey, lines, CASE WHEN lines IS NULL THEN 'incomplete' ELSE 'complete' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem WHERE l_quantity > 40 GROUP BY 1) ON l_orderkey = o_orderkey")
def _(t):
    lines = t.lineitem.where("l_quantity > 40").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    return t.orders.select("o_orderkey").join(lines, "o_orderkey", "left").withColumn("status", F.when(F.col("lines").isNull(), "incomplete").otherwise("complete"))


@query("snk_09_readiness", """WITH c AS (SELECT count(*) = 5 AS ok FROM region UNION ALL SELECT count(*) = 25 FROM nation UNION ALL SELECT count(*) = count(DISTINCT p_partkey) FROM part) SELECT bool_and(ok) AS ready, count(*) AS parts FROM c""")
def _(t):
    m = V.ledger(V.row_count(t.region, "region", 5), V.row_count(t.nation, "nation", 25), V.unique(t.part, "part", "p_partkey"))
    return m.agg(F.bool_and(F.col("status") == "PASS").alias("ready"), F.count("*").alias("parts"))


@query("src_16_text_sample", "SELECT page_id, substr(html, 1, 30000) AS head FROM pages")
def _(t):
    return t.pages.select("page_id", F.substring("html", 1, 30000).alias("head"))


@query("src_17_magic_bytes", "SELECT n_nationkey, (['pdf', 'zip', 'csv'])[n_nationkey % 3 + 1] AS type FROM nation")
def _(t):
    head = F.when(F.col("n_nationkey") % 3 == 0, F.unhex(F.lit("255044462D"))).when(F.col("n_nationkey") % 3 == 1, F.unhex(F.lit("504B0304"))).otherwise(F.unhex(F.lit("6162")))
    return t.nation.select("n_nationkey", S.detected_type(head, F.lit("a.CSV")).alias("type"))


@query("src_18_parser_dispatch", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS parsed, CASE WHEN event_id % 3 = 0 THEN 'unsupported' ELSE 'ok' END AS parse_status FROM events")
def _(t):
    raw = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("event_id").cast("string"))
    parsed = raw.try_cast("long")
    return t.events.select("event_id", parsed.alias("parsed"), F.when(parsed.isNull(), "unsupported").otherwise("ok").alias("parse_status"))


@query("src_22_nonblank_rows", "SELECT count(*) AS n FROM customer WHERE c_custkey % 4 <> 0")
def _(t):
    c = t.customer.select(F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.col("c_name")).alias("a"), F.lit("").alias("b"))
    return c.where((F.trim("a") != "") | (F.trim("b") != "")).agg(F.count("*").alias("n"))


@query("st_35_component_address", "SELECT s_suppkey, 'Old' || s_suppkey || 'road' AS address FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.regexp_replace(X.normalize_name(F.concat(F.lit("Old, "), F.col("s_suppkey").cast("string"), F.lit(" - road."))), "[^0-9A-Za-z]", "").alias("address"))


@query("er_13_component_reasons", "SELECT s_suppkey, CASE WHEN s_nationkey > 20 THEN 'region' WHEN s_acctbal < 0 THEN 'street' WHEN s_suppkey % 5 = 0 THEN 'number' ELSE '' END AS reject FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", P.ladder((F.col("s_nationkey") > 20, "region"), (F.col("s_acctbal") < 0, "street"), (F.col("s_suppkey") % 5 == 0, "number"), otherwise="").alias("reject"))


@query("er_11_precision", "SELECT o_custkey, max(o_orderkey) FILTER (WHERE o_totalprice > 100000) AS exact, count(*) AS offers FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.max(F.when(F.col("o_totalprice") > 100000, F.col("o_orderkey"))).alias("exact"), F.count("*").alias("offers"))
