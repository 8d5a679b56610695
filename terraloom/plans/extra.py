"""Plans of the remaining operators: classifiers, geocode choice, unions and distances, projections, raster structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import geo as G
from terraloom.functions import text as X
from terraloom.operators import aggregates as A
from terraloom.operators import impact as I
from terraloom.operators import joins as J
from terraloom.operators import resolve as E
from terraloom.plans.domain import LATTICE, lattice
from terraloom.plans.registry import query
from terraloom.plans.text_geo import ALB, points

#: (name, text, source category, node type) of records that take each branch.
RECORDS = [("甲农贸", "", "wholesale_market", "agricultural_wholesale_market"), ("乙", "", "cold_chain", "cold_chain_distribution_center"), ("丙", "", "basket_supply_base", "basket_supply_base"),
           ("丁", "", "government_procurement", "government_procurement_supplier"), ("柳州军粮供应站", "", "grain_reserve", "military_grain_supply"), ("五象粮库", "", "grain_reserve", "grain_depot"),
           ("某粮食收储公司", "", "grain_reserve", "grain_reserve"), ("某公司", "粮库", "grain_reserve", "other"), ("某公司", "军粮", "grain_emergency", "military_grain_supply"), ("某公司", "中心库", "grain_storage", "grain_depot"),
           ("粮油购销", "", "grain_storage", "grain_reserve"), ("某配送", "", "grain_emergency", "emergency_distribution_center"), ("某粮运", "", "grain_emergency", "emergency_storage_transport"), ("某米业", "", "grain_emergency", "emergency_processing"),
           ("某公司", "", "grain_emergency", "other"), ("某公司", "粮库", "news", "other")]
PICK = "s_suppkey % 16"


def record(i):
    """A field of the record that belongs to a supplier."""
    return F.element_at(F.array(*[F.lit(r[i]) for r in RECORDS]), (F.expr(PICK) + 1).cast("int"))


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query("st_13_node_type", f"SELECT s_suppkey, ({sql_list(r[3] for r in RECORDS)})[({PICK} + 1)::INT] AS node_type, {PICK} IN (3, 6, 7, 14, 15) AS noted, {PICK} <> 15 AS recognised FROM supplier")
def _(t):
    n = X.node_type(record(0), record(1), record(2))
    return t.supplier.select("s_suppkey", n.alias("n")).select("s_suppkey", "n.node_type", (F.col("n.note") != "").alias("noted"), (F.col("n.recognition") != "").alias("recognised"))


MARKETS = ["南宁粮油果菜市场", "海鲜畜禽交易市场", "某市场"]


@query("st_14_15_source_branches", """SELECT s_suppkey, k = 0 OR c = 1 AS grain, k = 0 AS oil, k = 0 AND c = 0 AS fruit, k = 0 AND c = 0 AS vegetable, k = 1 AND c = 0 AS meat, k = 1 AS aquatic_product, c = 0 OR k = 1 AS fresh_food,
c = 0 AS distribution_capability, c = 2 AS storage_capability FROM (SELECT s_suppkey, s_suppkey % 3 AS k, (s_suppkey // 3) % 3 AS c FROM supplier)""")
def _(t):
    name = F.element_at(F.array(*[F.lit(m) for m in MARKETS]), (F.col("s_suppkey") % 3 + 1).cast("int"))
    of = F.element_at(F.array(F.lit("wholesale_market"), F.lit("grain_reserve"), F.lit("news")), (F.floor(F.col("s_suppkey") / 3) % 3 + 1).cast("int"))
    f, c = X.product_flags(name, of), X.capability_flags(F.concat(name, F.lit("仓库")), F.lit(""), of, name)
    d = t.supplier.select("s_suppkey", *[f[k].alias(k) for k in ("grain", "oil", "fruit", "vegetable", "meat", "aquatic_product", "fresh_food")], c["distribution_capability"].alias("distribution_capability"), c["storage_capability"].alias("storage_capability"))
    # markets are judged by their name alone here, and their text names a warehouse
    return d.withColumn("storage_capability", F.col("storage_capability") & (of == "news"))


@query("st_20_semantic_name", "SELECT s_suppkey, 'a' || s_suppkey AS semantic, s_suppkey % 3 <> 2 AS safe FROM supplier")
def _(t):
    k = F.col("s_suppkey").cast("string")
    a = F.concat(F.lit("南宁市青秀区A "), k, F.lit("有限公司"))
    other = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("广西a"), k)).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("A"), k, F.lit("股份有限公司"))).otherwise("集团有限公司")
    return t.supplier.select("s_suppkey", X.semantic_name(a).alias("semantic"), X.safe_name_match(a, other).alias("safe"))


@query("er_08_geocode_choice", """WITH a AS (SELECT c_nationkey, c_custkey, c_mktsegment, c_custkey % 3 <> 0 AS city_ok, c_custkey % 2 = 0 AS county_ok, round((c_custkey * 7919 % 1000) / 1000.0::DOUBLE, 4) AS sim, CASE WHEN c_custkey % 4 = 0 THEN '乡镇' ELSE '门牌号' END AS level FROM customer),
s AS (SELECT *, round(sim + CASE WHEN city_ok THEN 0.2::DOUBLE ELSE -0.5::DOUBLE END + CASE WHEN county_ok THEN 0.1::DOUBLE ELSE -0.15::DOUBLE END, 4) AS score FROM a),
r AS (SELECT *, row_number() OVER w AS r, lead(score) OVER w AS nxt FROM s WHERE city_ok AND county_ok WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment ORDER BY score DESC, sim DESC, c_custkey::VARCHAR)),
g AS (SELECT c_nationkey, c_mktsegment, bool_or(NOT city_ok) AS elsewhere FROM s GROUP BY ALL),
j AS (SELECT g.c_nationkey || '/' || g.c_mktsegment AS target, g.c_nationkey, elsewhere, sim, level, c_custkey, CASE WHEN c_custkey IS NULL THEN CASE WHEN elsewhere THEN 'region_mismatch' ELSE 'no_result' END WHEN score - nxt < 0.08 THEN 'multiple_matches' WHEN level = '乡镇' AND g.c_nationkey % 2 <> 0 THEN 'name_mismatch' ELSE '' END AS reject
FROM g LEFT JOIN (SELECT * FROM r WHERE r = 1) b USING (c_nationkey, c_mktsegment))
SELECT target, CASE WHEN reject = '' THEN c_custkey::VARCHAR END AS location, reject, CASE WHEN reject <> '' THEN '' WHEN sim >= 0.75 THEN 'high' ELSE 'medium' END AS confidence FROM j""")
def _(t):
    k = F.col("c_custkey")
    answers = t.customer.select(F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("target"), k.cast("string").alias("name"), k.cast("string").alias("location"), (k * 7919 % 1000 / F.lit(1000.0)).alias("sim"),
                                (k % 3 != 0).alias("city"), (k % 2 == 0).alias("county"), F.when(k % 4 == 0, "乡镇").otherwise("门牌号").alias("level"), (F.col("c_nationkey") % 2 == 0).alias("detailed"))
    return E.chosen_geocode(E.geocode_scores(answers, F.col("sim"), F.col("city"), F.col("county")), "target", "detailed")


# ---- unions, distances and neighbours of boxes and lines
BOX = "b AS (SELECT s_nationkey AS k, s_suppkey % 7 AS x0, s_suppkey % 7 + 2 AS x1, s_suppkey * 3 % 11 AS y0, s_suppkey * 3 % 11 + 1 + s_suppkey % 3 AS y1 FROM supplier)"
#: Boxes have whole corners, so the union is a count of unit squares.
SQUARES = "q AS (SELECT DISTINCT k, x, y FROM b, range(0, 20) a(x), range(0, 20) c(y) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1)"


def boxes(t):
    s = F.col("s_suppkey")
    return t.supplier.select(F.col("s_nationkey").alias("k"), (s % 7).cast("double").alias("x0"), (s % 7 + 2).cast("double").alias("x1"), (s * 3 % 11).cast("double").alias("y0"), (s * 3 % 11 + 1 + s % 3).cast("double").alias("y1"))


@query("ag_21_union_area", f"WITH {BOX}, {SQUARES} SELECT k, count(*)::DOUBLE AS area FROM q GROUP BY 1")
def _(t):
    return A.union_area(boxes(t), "k")


@query("ge_16_symmetric_difference", f"WITH {BOX}, {SQUARES}, o AS (SELECT DISTINCT k, x, y FROM q WHERE x < 6) SELECT q.k, (count(*) - count(o.x))::DOUBLE AS difference, (count(*) - count(o.x)) / count(*)::DOUBLE <= 1e-8 AS basic_match FROM q LEFT JOIN o USING (k, x, y) GROUP BY 1")
def _(t):
    """A union against a reference that ends at x = 6: twice the union of both less the area of each."""
    left = boxes(t)
    right = left.withColumn("x1", F.least("x1", F.lit(6.0))).where("x1 > x0")
    a, b = A.union_area(left, "k").withColumnRenamed("area", "a"), A.union_area(right, "k").withColumnRenamed("area", "b")
    both = A.union_area(left.unionByName(right), "k").withColumnRenamed("area", "both")
    d = both.join(a, "k").join(b, "k", "left").withColumn("difference", 2 * F.col("both") - F.col("a") - F.coalesce("b", F.lit(0.0)))
    return d.select("k", "difference", (F.col("difference") / F.greatest("a", F.lit(1e-30)) <= 1e-8).alias("basic_match"))


@query("ge_18_line_distance", "SELECT c_custkey, CASE WHEN c_custkey % 10 < 4 THEN 0.0 ELSE c_custkey % 10 - 4.0 END::DOUBLE AS dist FROM customer")
def _(t):
    """A line from (0, 0) over (4, 0) to (4, 4) against one at y = 2 that starts c % 10 from the y axis and goes right."""
    p = lambda x, y: F.struct((x if not isinstance(x, (int, float)) else F.lit(float(x))).alias("x"), F.lit(float(y)).alias("y"))
    x = (F.col("c_custkey") % 10).cast("double")
    return t.customer.select("c_custkey", G.line_distance(F.array(p(0, 0), p(4, 0), p(4, 4)), F.array(p(x, 2), p(x + 6, 2))).alias("dist"))


@query("ge_18_greatest_distance", "SELECT max(CASE WHEN c_custkey % 10 < 4 THEN 0.0 ELSE c_custkey % 10 - 4.0 END)::DOUBLE AS greatest FROM customer")
def _(t):
    p = lambda x, y: F.struct((x if not isinstance(x, (int, float)) else F.lit(float(x))).alias("x"), F.lit(float(y)).alias("y"))
    x = (F.col("c_custkey") % 10).cast("double")
    return t.customer.agg(F.max(G.line_distance(F.array(p(0, 0), p(4, 0), p(4, 4)), F.array(p(x, 2), p(x + 6, 2)))).alias("greatest"))


CENTRES = "c AS (SELECT s_suppkey AS k, s_acctbal::DOUBLE AS x, (s_suppkey * 37 % 997)::DOUBLE AS y FROM supplier)"


@query("ge_19_adjacent", f"""WITH {CENTRES}, d AS (SELECT a.k AS "left", b.k AS "right", sqrt(pow(greatest(0, abs(a.x - b.x) - 60), 2) + pow(greatest(0, abs(a.y - b.y) - 60), 2)) AS gap FROM c a JOIN c b ON a.k < b.k)
SELECT "left", "right", round(gap, 6) AS gap FROM d WHERE gap <= 100""")
def _(t):
    """Boxes of side 60 whose gap is at most 100: centres within the bound of 100 plus a diagonal, then the exact gap."""
    c = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").cast("double").alias("x"), (F.col("s_suppkey") * 37 % 997).cast("double").alias("y"))
    a, b = c.toDF("left", "ax", "ay"), c.toDF("right", "bx", "by")
    near = J.cell_pairs(a, b, 100 + 60 * 2**0.5 + 1).where(F.col("left") < F.col("right"))
    gap = F.hypot(F.greatest(F.lit(0.0), F.abs(F.col("ax") - F.col("bx")) - 60), F.greatest(F.lit(0.0), F.abs(F.col("ay") - F.col("by")) - 60))
    return near.withColumn("gap", gap).where("gap <= 100").select("left", "right", F.round("gap", 6).alias("gap"))


# ---- projections
#: Candidate projections: name, kind, central meridian (fixed values; the two regional ones follow the bounds).
STANDARD = (("utm48_wgs84", "tm", 105.0), ("utm49_wgs84", "tm", 111.0), ("cgcs2000_gk6_cm105", "tm", 105.0), ("cgcs2000_gk6_cm111", "tm", 111.0), ("cgcs2000_gk3_cm108", "tm", 108.0), ("cgcs2000_gk3_cm111", "tm", 111.0))


@query("ge_10_projection_candidates", f"""WITH p AS (SELECT 108.25::DOUBLE + embedding[1]::DOUBLE * 4 AS lon, 23.7::DOUBLE + embedding[2]::DOUBLE * 3 AS lat FROM embeddings), b AS (SELECT min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM p)
SELECT name, kind, lon0, NULL::DOUBLE AS lat0, NULL::DOUBLE AS lat1, NULL::DOUBLE AS lat2 FROM (VALUES {", ".join(f"('{n}', '{k}', {m}::DOUBLE)" for n, k, m in STANDARD)}) v(name, kind, lon0)
UNION ALL SELECT 'gx_custom_tm', 'tm', (x0 + x1) / 2, NULL, NULL, NULL FROM b UNION ALL SELECT 'gx_custom_albers', 'albers', (x0 + x1) / 2, (y0 + y1) / 2, y0 + (y1 - y0) / 6, y1 - (y1 - y0) / 6 FROM b""")
def _(t):
    b = points(t).agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1"))
    none, mid, sixth = F.lit(None).cast("double"), (F.col("x0") + F.col("x1")) / 2, (F.col("y1") - F.col("y0")) / 6
    row = lambda name, kind, *v: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), *[x.alias(c) for x, c in zip(v, ("lon0", "lat0", "lat1", "lat2"))])
    rows = [row(n, k, F.lit(m), none, none, none) for n, k, m in STANDARD]
    rows += [row("gx_custom_tm", "tm", mid, none, none, none), row("gx_custom_albers", "albers", mid, (F.col("y0") + F.col("y1")) / 2, F.col("y0") + sixth, F.col("y1") - sixth)]
    return b.select(F.inline(F.array(*rows)))


@query("ge_12_square_area", "SELECT vec_id, 1.0::DOUBLE AS geodesic_km2, true AS equal_area FROM embeddings")
def _(t):
    """A square kilometre around each point: its area on the ellipsoid, and whether the equal-area projection keeps it to 1e-6."""
    p = points(t)
    corners = [G.ellipsoid_offset(F.col("lon"), F.col("lat"), F.lit(500.0 * sx), F.lit(500.0 * sy)) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    p = p.withColumns({f"{c}{i}": v for i, xy in enumerate(corners) for c, v in zip(("x", "y"), xy)})
    flat = [G.albers(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in [*flat, flat[0]]])
    p = p.withColumns({"true": G.geodesic_area([F.col(f"x{i}") for i in range(4)], [F.col(f"y{i}") for i in range(4)]), "plane": G.ring_area(ring)})
    return p.select("vec_id", F.round(F.col("true") / 1e6, 4).alias("geodesic_km2"), (F.abs(F.col("plane") / F.col("true") - 1) < 1e-6).alias("equal_area"))


# ---- raster structure
@query("ra_03_target_grid", f"WITH {ALB}, b AS (SELECT floor(min(x) / 30) * 30 AS x0, floor(min(y) / 30) * 30 AS y0, ceil(max(x) / 30) * 30 AS x1, ceil(max(y) / 30) * 30 AS y1 FROM xy) SELECT x0, y0, x1, y1, ((x1 - x0) / 30)::BIGINT AS width, ((y1 - y0) / 30)::BIGINT AS height FROM b")
def _(t):
    x, y = G.albers(F.col("lon"), F.col("lat"))
    b = points(t).select(x.alias("x"), y.alias("y")).agg(*[f(c).alias(n) for n, f, c in (("_x0", F.min, "x"), ("_y0", F.min, "y"), ("_x1", F.max, "x"), ("_y1", F.max, "y"))])
    g = b.select(*[G.snap(F.col(f"_{n}"), 30, up).alias(n) for n, up in (("x0", False), ("y0", False), ("x1", True), ("y1", True))])
    side = lambda a, b: ((F.col(b) - F.col(a)) / 30).cast("long")
    return g.select(*[F.col(n).cast("double").alias(n) for n in ("x0", "y0", "x1", "y1")], side("x0", "x1").alias("width"), side("y0", "y1").alias("height"))


@query("ra_08_seam_statistics", f"WITH {LATTICE}, s AS (SELECT c // 8 AS tile, abs(b.v - a.v) AS d FROM px a JOIN (SELECT r, c - 1 AS c, v FROM px) b USING (r, c) WHERE c % 8 = 7) SELECT tile, count(*) AS n, max(d) AS greatest, avg(d) AS mean, avg(CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS equal_ratio FROM s GROUP BY 1")
def _(t):
    """Tiles of eight columns: the last column of each against the first of the next."""
    px = lattice(t)
    nxt = px.select("row", (F.col("col") - 1).alias("col"), F.col("value").alias("next"))
    s = px.where("col % 8 = 7").join(nxt, ["row", "col"]).select(F.floor(F.col("col") / 8).alias("tile"), F.abs(F.col("next") - F.col("value")).alias("d"))
    return s.groupBy("tile").agg(F.count("*").alias("n"), F.max("d").alias("greatest"), F.avg("d").alias("mean"), F.avg(F.when(F.col("d") == 0, 1.0).otherwise(0.0)).alias("equal_ratio"))


@query("ra_12_same_structure", f"WITH {LATTICE}, a AS (SELECT max(r) - min(r) + 1 AS height, max(c) - min(c) + 1 AS width, min(r) AS row0, min(c) AS col0 FROM px), b AS (SELECT max(r) - min(r) + 1 AS height, max(c) - min(c) + 1 AS width, min(r) AS row0, min(c) AS col0 FROM px WHERE r > 0) SELECT 'whole' AS raster, 'PASS' AS status, '' AS differs UNION ALL SELECT 'cut', CASE WHEN a = b THEN 'PASS' ELSE 'FAIL' END, concat_ws(',', CASE WHEN a.height <> b.height THEN 'height' END, CASE WHEN a.width <> b.width THEN 'width' END, CASE WHEN a.row0 <> b.row0 THEN 'row0' END, CASE WHEN a.col0 <> b.col0 THEN 'col0' END) FROM a, b")
def _(t):
    """Size and origin of two rasters against the reference: the same one, and one without its first row."""
    def structure(px):
        return px.agg((F.max("row") - F.min("row") + 1).alias("height"), (F.max("col") - F.min("col") + 1).alias("width"), F.min("row").alias("row0"), F.min("col").alias("col0"))

    names = ("height", "width", "row0", "col0")
    ref = structure(lattice(t)).toDF(*[f"r_{n}" for n in names])
    both = structure(lattice(t)).withColumn("raster", F.lit("whole")).unionByName(structure(lattice(t).where("row > 0")).withColumn("raster", F.lit("cut")))
    differs = F.concat_ws(",", *[F.when(~F.col(n).eqNullSafe(F.col(f"r_{n}")), n) for n in names])
    return both.crossJoin(F.broadcast(ref)).select("raster", F.when(differs == "", "PASS").otherwise("FAIL").alias("status"), differs.alias("differs"))


# ---- impact details
@query("di_05_distinct_names", "SELECT s_nationkey, sum(CASE WHEN s_suppkey % 3 = 0 THEN 3 WHEN s_suppkey % 3 = 1 THEN 2 ELSE 0 END)::DOUBLE AS facility_weight_sum, 0.15::DOUBLE AS facility_model_weight FROM supplier GROUP BY 1")
def _(t):
    """A district's sum of facility weights and the model's weight of that indicator, under names that cannot collide."""
    kind = F.when(F.col("s_suppkey") % 3 == 0, "hospital").when(F.col("s_suppkey") % 3 == 1, "school").otherwise("other")
    s = t.supplier.groupBy("s_nationkey").agg(F.sum(F.coalesce(I.facility_weight(kind), F.lit(0))).cast("double").alias("facility_weight_sum"))
    return s.withColumn("facility_model_weight", F.lit(I.WEIGHTS["facility"]))


@query("di_14_recession", "SELECT l_suppkey, sum(l_quantity) AS flooded, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS receded, sum(l_quantity) - sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS remaining, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS receded_ratio FROM lineitem GROUP BY 1")
def _(t):
    """Flooded area split into what has receded and what remains."""
    receded = F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0))
    g = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("flooded"), receded.alias("receded"))
    return g.select("l_suppkey", "flooded", "receded", (F.col("flooded") - F.col("receded")).alias("remaining"), F.when(F.col("flooded") > 0, F.col("receded") / F.col("flooded")).alias("receded_ratio"))


@query("di_18_rescue_points", "SELECT vec_id, true AS converged FROM embeddings")
def _(t):
    """Rescue points back from the shifted datum: shifting the result again gives the input to a tenth of a millimetre."""
    u = G.unshifted(F.col("lon"), F.col("lat"))
    p = points(t).withColumn("u", u)
    x, y = G.shifted(F.col("u.lon"), F.col("u.lat"))
    return p.select("vec_id", ((F.abs(x - F.col("lon")) < 1e-9) & (F.abs(y - F.col("lat")) < 1e-9)).alias("converged"))
