"""Plans of impact, priority, validation, rasters, entity resolution, sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.functions import text as X
from terraloom.operators import impact as I
from terraloom.operators import raster as R
from terraloom.operators import resolve as E
from terraloom.operators import validation as V
from terraloom.operators import windows as W
from terraloom.plans.registry import query
from terraloom.sources import readers as S
from terraloom.sources import writers as K
from terraloom.streaming import events as EV

# ---- impact: districts are nations, indicators come from customers, orders and suppliers
INDICATORS = """ind AS (SELECT n_nationkey, coalesce(c.population, 0)::DOUBLE AS population, coalesce(s.facility, 0)::DOUBLE AS facility, coalesce(c.flood_area, 0)::DOUBLE AS flood_area, coalesce(s.road, 0)::DOUBLE AS road, coalesce(c.settlements, 0)::DOUBLE AS settlements, (n_nationkey % 7)::DOUBLE AS rescue_distance
FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS population, sum(c_acctbal) AS flood_area, count(DISTINCT c_mktsegment) AS settlements FROM customer WHERE c_acctbal > 5000 GROUP BY 1) c ON c_nationkey = n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS facility, sum(s_acctbal) AS road FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey)"""
NORM = "nrm AS (SELECT n_nationkey, " + ", ".join(f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0 END AS {c}" for c in I.WEIGHTS) + " FROM ind)"


def indicators(t):
    c = t.customer.where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").cast("double").alias("population"), F.sum("c_acctbal").alias("flood_area"), F.countDistinct("c_mktsegment").cast("double").alias("settlements"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").cast("double").alias("facility"), F.sum("s_acctbal").alias("road"))
    d = t.nation.select("n_nationkey").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").fillna(0.0)
    return d.withColumn("rescue_distance", (F.col("n_nationkey") % 7).cast("double"))


@query("di_03_district_summary", f"WITH {INDICATORS} SELECT n_nationkey, population, facility, round(flood_area, 4) AS flood_area FROM ind")
def _(t):
    return indicators(t).select("n_nationkey", "population", "facility", F.round("flood_area", 4).alias("flood_area"))


SCORE = " + ".join(f"{c} * {w}::DOUBLE" for c, w in I.WEIGHTS.items())


@query("di_04_priority_score", f"WITH {INDICATORS}, {NORM}, s AS (SELECT n_nationkey, {SCORE} AS score FROM nrm) SELECT n_nationkey, round(score, 9) AS score, rank() OVER (ORDER BY round(score, 12) DESC)::INT AS rank FROM s")
def priority_score(t):
    return I.priority(indicators(t)).select("n_nationkey", F.round("score", 9).alias("score"), "rank")


CASES = " UNION ALL ".join(f"SELECT n_nationkey, {i} AS sc, " + " + ".join(f"{c} * {w * (1 + (s if c == k else 0))!r}::DOUBLE" for c, w in I.WEIGHTS.items()) + " AS score FROM nrm" for i, (k, s) in enumerate((k, s) for k in I.WEIGHTS for s in (-0.2, 0.2)))


@query("di_06_sensitivity", f"WITH {INDICATORS}, {NORM}, s AS ({CASES}), r AS (SELECT n_nationkey, rank() OVER (PARTITION BY sc ORDER BY round(score, 12) DESC) AS r FROM s) SELECT n_nationkey, min(r)::INT AS rank_min, max(r)::INT AS rank_max, min(r) = max(r) AS stable FROM r GROUP BY 1")
def _(t):
    return I.sensitivity(indicators(t), "n_nationkey")


@query("di_01_exposure", "SELECT s_suppkey, CASE WHEN s_suppkey % 50 * 12 = 0 THEN 'inside_flood' WHEN s_suppkey % 50 * 12 <= 500 THEN 'near_flood' END AS exposure FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", I.exposure(F.col("s_suppkey") % 50 * 12).alias("exposure"))


@query("di_02_facility_weights", "SELECT s_nationkey, sum(CASE s_suppkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 3 ELSE 2 END)::BIGINT AS weight_sum FROM supplier GROUP BY 1")
def _(t):
    kind = F.when(F.col("s_suppkey") % 3 == 0, "hospital").when(F.col("s_suppkey") % 3 == 1, "elderly_home").otherwise("school")
    return t.supplier.groupBy("s_nationkey").agg(F.sum(I.facility_weight(kind)).alias("weight_sum"))


@query("di_08_eligibility", "SELECT s_suppkey, s_acctbal >= 0 AS eligible, CASE WHEN s_acctbal < 0 THEN 'under_construction' ELSE '' END AS reason FROM supplier")
def _(t):
    bad = F.col("s_acctbal") < 0
    return t.supplier.select("s_suppkey", (~bad).alias("eligible"), F.when(bad, "under_construction").otherwise("").alias("reason"))


@query("di_09_shortest_path")
def _(t):
    edges = t.supplier.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("u"), F.concat(F.lit("n"), ((F.col("s_nationkey") * 3 + 1) % 25).cast("string")).alias("v"), (F.abs("s_acctbal") + 1).alias("w"))
    origins = t.region.select(F.col("r_regionkey").alias("case"), F.concat(F.lit("n"), F.col("r_regionkey").cast("string")).alias("node"))
    return I.shortest_paths(edges, origins)


@query("di_10_source_retry", """WITH a AS (SELECT c_nationkey AS cs, s_suppkey, s_suppkey * 10 + c_nationkey AS dist, s_suppkey % 4 = 0 AS ok FROM (SELECT DISTINCT c_nationkey FROM customer), supplier WHERE s_suppkey <= 7),
r AS (SELECT *, row_number() OVER (PARTITION BY cs ORDER BY dist) AS r FROM a) SELECT cs AS c, min(dist) FILTER (WHERE ok) AS dist, coalesce(min(r) FILTER (WHERE ok), count(*)) AS attempts, CASE WHEN min(r) FILTER (WHERE ok) IS NULL THEN 'no_safe_route' ELSE 'assigned' END AS status FROM r GROUP BY 1""")
def _(t):
    a = t.customer.select(F.col("c_nationkey").alias("c")).distinct().crossJoin(F.broadcast(t.supplier.where("s_suppkey <= 7"))).withColumn("dist", F.col("s_suppkey") * 10 + F.col("c"))
    return I.first_success(a, "c", "dist", F.col("s_suppkey") % 4 == 0).withColumn("attempts", F.col("attempts").cast("long"))


@query("di_11_demand", "SELECT c_custkey, (ceil(c_acctbal) * 3)::BIGINT AS food, (ceil(c_acctbal) * 3)::BIGINT AS water, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS inventory, CASE WHEN c_custkey % 2 = 0 THEN 'known' ELSE 'unknown' END AS status FROM customer WHERE c_acctbal > 0")
def _(t):
    food, water = I.demand(F.col("c_acctbal"))
    known = F.col("c_custkey") % 2 == 0
    return t.customer.where("c_acctbal > 0").select("c_custkey", food.alias("food"), water.alias("water"), F.when(known, F.col("c_acctbal")).alias("inventory"), F.when(known, "known").otherwise("unknown").alias("status"))


@query("di_12_shelter_use", "SELECT o_orderkey, round(least(o_totalprice, 200000) / 200000, 9) AS used, round(200000 - least(o_totalprice, 200000), 4) AS remaining FROM orders")
def _(t):
    got = F.least(F.col("o_totalprice"), F.lit(200000.0))
    return t.orders.select("o_orderkey", F.round(got / 200000, 9).alias("used"), F.round(200000 - got, 4).alias("remaining"))


@query("di_13_trend", """WITH d AS (SELECT user_id, event_type, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events), g AS (SELECT user_id, count(*) FILTER (WHERE d > 0) AS up, count(*) FILTER (WHERE d < 0) AS down, count(d) AS n, bool_or(event_type = 'purchase') AS red FROM d GROUP BY 1)
SELECT user_id, CASE WHEN red AND up * 2 > n THEN 'continued_expansion_possible' WHEN down = n THEN 'receding_by_followup_date' ELSE 'undetermined' END AS trend FROM g""")
def _(t):
    d = t.events.withColumn("d", W.delta("value", "user_id", "ts", "event_id"))
    g = d.groupBy("user_id").agg(F.count_if(F.col("d") > 0).alias("up"), F.count_if(F.col("d") < 0).alias("down"), F.count("d").alias("n"), F.bool_or(F.col("event_type") == "purchase").alias("red"))
    return g.select("user_id", I.trend(F.col("up"), F.col("down"), F.col("n"), F.col("red")).alias("trend"))


@query("di_17_only_located", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'spatially_located' ELSE 'not_spatially_located' END AS location_status, o_orderkey % 3 = 0 AS applied FROM orders")
def _(t):
    on = F.col("o_orderkey") % 3 == 0
    return t.orders.select("o_orderkey", F.when(on, "spatially_located").otherwise("not_spatially_located").alias("location_status"), on.alias("applied"))


# ---- validation
@query("va_01_uniqueness", "SELECT 'l' AS \"check\", (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem")
def _(t):
    return V.unique(t.lineitem, "l", "l_orderkey", "l_linenumber")


@query("va_02_row_count", "SELECT 'nation' AS \"check\", count(*)::DOUBLE AS observed, 25::DOUBLE AS expected, CASE WHEN count(*) = 25 THEN 'PASS' ELSE 'FAIL' END AS status FROM nation")
def _(t):
    return V.row_count(t.nation, "nation", 25)


@query("va_03_enum", "SELECT 'status' AS \"check\", count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders")
def _(t):
    return V.enumerated(t.orders, "status", "o_orderstatus", ["F", "O"])


@query("va_04_references", "SELECT 'custkey' AS \"check\", count(*)::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def _(t):
    return V.references(t.orders, "custkey", "o_custkey", t.customer, "c_custkey")


@query("va_05_conservation", "SELECT 'quantity' AS \"check\", (SELECT sum(q) FROM (SELECT sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey)) AS observed, (SELECT sum(l_quantity) FROM lineitem) AS expected, CASE WHEN abs((SELECT sum(q) FROM (SELECT sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey)) - (SELECT sum(l_quantity) FROM lineitem)) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status")
def _(t):
    return V.conserved(t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")), F.col("q"), t.lineitem, F.col("l_quantity"), "quantity", 0.01)


@query("va_06_ratio_range", "SELECT 'discount' AS \"check\", count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 1)::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN bool_and(l_discount BETWEEN 0 AND 1) THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem")
def _(t):
    return V.violations(t.lineitem, "discount", ~F.col("l_discount").between(0, 1))


@query("va_07_cross_field", "SELECT 'flag' AS \"check\", count(*) FILTER (WHERE (l_returnflag = 'N') <> (l_linestatus = 'O'))::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN count(*) FILTER (WHERE (l_returnflag = 'N') <> (l_linestatus = 'O')) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem")
def _(t):
    return V.violations(t.lineitem, "flag", (F.col("l_returnflag") == "N") != (F.col("l_linestatus") == "O"))


@query("va_08_code_names", "SELECT p_brand, count(DISTINCT p_type) AS names FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def _(t):
    return t.part.groupBy("p_brand").agg(F.countDistinct("p_type").alias("names")).where("names > 1")


@query("va_09_coordinate_range", "SELECT 'range' AS \"check\", count(*) FILTER (WHERE NOT (embedding[1] BETWEEN -1 AND 1))::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN count(*) FILTER (WHERE NOT (embedding[1] BETWEEN -1 AND 1)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM embeddings")
def _(t):
    return V.violations(t.embeddings, "range", ~F.col("embedding")[0].between(-1, 1))


@query("va_10_shared_locations", "SELECT s_nationkey, count(*) AS entities FROM supplier GROUP BY 1 HAVING count(*) >= 5")
def _(t):
    return t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("entities")).where("entities >= 5")


def some_checks(t):
    return V.ledger(V.unique(t.orders, "orders_key", "o_orderkey"), V.references(t.orders, "orders_customer", "o_custkey", t.customer, "c_custkey"), V.violations(t.lineitem, "quantity", F.col("l_quantity") <= 0), V.row_count(t.region, "regions", 5))


CHECKS = """checks AS (SELECT 'orders_key' AS "check", count(*) = count(DISTINCT o_orderkey) AS ok FROM orders UNION ALL
SELECT 'orders_customer', count(*) = 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL
SELECT 'quantity', count(*) = 0 FROM lineitem WHERE l_quantity <= 0 UNION ALL SELECT 'regions', count(*) = 5 FROM region)"""
#: The same ledger with a repeated key, a lost reference, a bound that many rows break and a wrong count.
BROKEN = """checks AS (SELECT 'lines_key' AS "check", count(*) = count(DISTINCT l_orderkey) AS ok FROM lineitem UNION ALL
SELECT 'orders_customer', count(*) = 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) UNION ALL
SELECT 'quantity', count(*) = 0 FROM lineitem WHERE l_quantity > 25 UNION ALL SELECT 'regions', count(*) = 6 FROM region)"""
STATUS = """SELECT "check", CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM checks"""
REDUCED = "SELECT count(*) AS checks, CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END AS status, bool_and(ok) AS ready FROM checks"


def broken_checks(t):
    return V.ledger(V.unique(t.lineitem, "lines_key", "l_orderkey"), V.references(t.orders, "orders_customer", "o_custkey", t.customer.where("c_custkey % 2 = 0"), "c_custkey"),
                    V.violations(t.lineitem, "quantity", F.col("l_quantity") > 25), V.row_count(t.region, "regions", 6))


@query("va_14_ledger", f"WITH {CHECKS} {STATUS}")
def _(t):
    return some_checks(t).select("check", "status")


@query("va_14_ledger_failing", f"WITH {BROKEN} {STATUS}")
def _(t):
    return broken_checks(t).select("check", "status")


@query("va_13_15_reduction", f"WITH {CHECKS} {REDUCED}")
def _(t):
    return V.reduced(some_checks(t))


@query("va_13_15_reduction_failing", f"WITH {BROKEN} {REDUCED}")
def _(t):
    return V.reduced(broken_checks(t))


@query("va_05_conservation_failing", """WITH p AS (SELECT sum(l_quantity) AS p FROM lineitem WHERE l_suppkey % 3 <> 0), w AS (SELECT sum(l_quantity) AS w FROM lineitem)
SELECT 'quantity' AS "check", p AS observed, w AS expected, CASE WHEN abs(p - w) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM p, w""")
def _(t):
    parts = t.lineitem.where("l_suppkey % 3 <> 0").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    return V.conserved(parts, F.col("q"), t.lineitem, F.col("l_quantity"), "quantity", 0.01)


@query("va_06_09_range_failing", """SELECT 'discount' AS "check", count(*) FILTER (WHERE l_discount > 0.05)::DOUBLE AS observed, 0::DOUBLE AS expected, CASE WHEN max(l_discount) <= 0.05 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem UNION ALL
SELECT 'range', count(*) FILTER (WHERE embedding[1] > 0)::DOUBLE, 0::DOUBLE, CASE WHEN max(embedding[1]) <= 0 THEN 'PASS' ELSE 'FAIL' END FROM embeddings""")
def _(t):
    return V.ledger(V.violations(t.lineitem, "discount", ~F.col("l_discount").between(0, 0.05)), V.violations(t.embeddings, "range", F.col("embedding")[0] > 0))


@query("va_17_availability", "SELECT n_nationkey, CASE WHEN n = 0 THEN 'missing' WHEN n < 4 THEN 'candidate' ELSE 'available' END AS state FROM (SELECT n_nationkey, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1)")
def _(t):
    n = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_nationkey").agg(F.count("s_suppkey").alias("n"))
    return n.select("n_nationkey", F.when(F.col("n") == 0, "missing").when(F.col("n") < 4, "candidate").otherwise("available").alias("state"))


# ---- rasters: a lattice of 40 columns from the parts
def lattice(t):
    return t.part.select(F.floor((F.col("p_partkey") - 1) / 40).alias("row"), ((F.col("p_partkey") - 1) % 40).alias("col"), F.col("p_retailprice").alias("value"))


LATTICE = "px AS (SELECT floor((p_partkey - 1) / 40)::BIGINT AS r, ((p_partkey - 1) % 40)::BIGINT AS c, p_retailprice AS v FROM part)"


@query("ra_05_horn_slope", f"""WITH {LATTICE}, g AS (SELECT a.r, a.c, count(*) AS n, sum(b.v * (b.c - a.c) * (2 - abs(b.r - a.r))) AS gx, sum(b.v * (b.r - a.r) * (2 - abs(b.c - a.c))) AS gy FROM px a JOIN px b ON abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1 GROUP BY ALL)
SELECT r AS row, c AS col, CASE WHEN n = 9 THEN round(degrees(atan(sqrt(gx * gx + gy * gy) / 240.0)), 6) END AS slope FROM g""")
def _(t):
    s = R.horn_slope(lattice(t), 30.0)
    return s.withColumn("slope", F.round("slope", 6))


@query("ra_01_mosaic", f"WITH {LATTICE} SELECT r AS row, c AS col, v AS value FROM px UNION ALL SELECT r, c + 40, v FROM px WHERE c >= 5")
def _(t):
    p = lattice(t)
    return R.mosaic((p, 0, 0), (p.withColumn("col", F.col("col") - 5).where("col >= 0"), 0, 45))


@query("ra_02_bilinear", f"WITH {LATTICE} SELECT a.r * 40 + a.c AS id, (a.v + b.v + d.v + e.v) / 4 AS value FROM px a LEFT JOIN px b ON b.r = a.r AND b.c = a.c + 1 LEFT JOIN px d ON d.r = a.r + 1 AND d.c = a.c LEFT JOIN px e ON e.r = a.r + 1 AND e.c = a.c + 1")
def _(t):
    p = lattice(t)
    return R.resampled(p, p.select((F.col("row") * 40 + F.col("col")).alias("id"), (F.col("row") + 0.5).alias("r"), (F.col("col") + 0.5).alias("c")))


@query("ra_04_mask", f"WITH {LATTICE} SELECT r AS row, c AS col, CASE WHEN (r + c) % 3 = 0 THEN v END AS value FROM px")
def _(t):
    p = lattice(t)
    return R.masked(p, p.where("(row + col) % 3 = 0"))


@query("ra_07_seam_select", f"WITH {LATTICE} SELECT r AS row, c AS col, CASE WHEN c < 20 THEN v ELSE -v END AS value FROM px")
def _(t):
    p = lattice(t)
    return R.seam_selected(p, p.withColumn("value", -F.col("value")), 20).select("row", "col", "value")


@query("ra_09_histogram", "SELECT p_size AS code, count(*) AS n FROM part GROUP BY 1")
def _(t):
    return t.part.groupBy(F.col("p_size").alias("code")).agg(F.count("*").alias("n"))


@query("ra_10_unexpected_codes", "SELECT p_size AS code, count(*) AS n FROM part WHERE p_size NOT BETWEEN 1 AND 45 GROUP BY 1")
def _(t):
    return t.part.where(~F.col("p_size").between(1, 45)).groupBy(F.col("p_size").alias("code")).agg(F.count("*").alias("n"))


# ---- entity resolution
@query("er_01_explicit_groups", "WITH RECURSIVE e AS (SELECT s_suppkey AS a, s_suppkey + 7 AS b FROM supplier WHERE s_suppkey % 3 = 0), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), w AS (SELECT a AS node, a AS root FROM u UNION SELECT u.b, w.root FROM w JOIN u ON u.a = w.node) SELECT node, min(root) AS root FROM w GROUP BY 1")
def _(t):
    e = t.supplier.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") + 7).alias("b"))
    return E.linked_groups(e, "a", "b")


CUST = "c AS (SELECT c_custkey, c_mktsegment AS kind, 'N' || c_custkey % 300 AS name, CASE WHEN c_custkey % 4 = 0 THEN upper(substr(md5((c_custkey % 60)::VARCHAR), 1, 18)) ELSE '' END AS code FROM customer)"
LINK = "l AS (SELECT name, kind, min(code) AS linked FROM c WHERE length(code) = 18 GROUP BY ALL HAVING min(code) = max(code))"


def cust(t):
    code = F.when(F.col("c_custkey") % 4 == 0, F.upper(F.substring(F.md5((F.col("c_custkey") % 60).cast("string").cast("binary")), 1, 18))).otherwise("")
    return t.customer.select("c_custkey", F.col("c_mktsegment").alias("kind"), F.concat(F.lit("N"), (F.col("c_custkey") % 300).cast("string")).alias("name"), code.alias("code"))


@query("er_02_unique_code", f"WITH {CUST}, {LINK} SELECT name, kind, linked AS linked_code FROM l")
def _(t):
    return E.unique_codes(cust(t), "name", "kind", "code")


@query("er_03_identity_key", f"WITH {CUST}, {LINK} SELECT c_custkey, CASE WHEN length(code) = 18 THEN 'credit:' || code || ':' || kind WHEN linked IS NOT NULL THEN 'credit:' || linked || ':' || kind ELSE 'name:' || name || ':' || kind END AS key FROM c LEFT JOIN l USING (name, kind)")
def _(t):
    c = cust(t)
    j = c.join(E.unique_codes(c, "name", "kind", "code"), ["name", "kind"], "left")
    return j.select("c_custkey", E.identity_key(F.col("code"), F.col("linked_code"), F.col("name"), F.col("kind"), F.col("c_custkey")).alias("key"))


@query("er_04_candidates", f"WITH {CUST}, {LINK}, k AS (SELECT *, CASE WHEN length(code) = 18 THEN 'credit:' || code || ':' || kind WHEN linked IS NOT NULL THEN 'credit:' || linked || ':' || kind ELSE 'name:' || name || ':' || kind END AS key FROM c LEFT JOIN l USING (name, kind)) SELECT key, count(*) AS records, min(name) AS name, bool_or(code <> '') AS coded FROM k GROUP BY 1")
def _(t):
    c = cust(t)
    j = c.join(E.unique_codes(c, "name", "kind", "code"), ["name", "kind"], "left")
    j = j.withColumn("key", E.identity_key(F.col("code"), F.col("linked_code"), F.col("name"), F.col("kind"), F.col("c_custkey")))
    return j.groupBy("key").agg(F.count("*").alias("records"), F.min("name").alias("name"), F.bool_or(F.col("code") != "").alias("coded"))


@query("er_06_worklist", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'missing_address' ELSE 'pending' END AS state FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, "missing_address").otherwise("pending").alias("state"))


@query("er_07_acceptance", "WITH r AS (SELECT o_custkey, o_totalprice AS s, lead(o_totalprice) OVER w AS n, row_number() OVER w AS r FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC)) SELECT o_custkey, CASE WHEN s < 100000 THEN 'rejected' WHEN s - n < 8000 THEN 'ambiguous' ELSE 'accepted' END AS decision FROM r WHERE r = 1")
def _(t):
    a = W.ambiguous(t.orders, "o_custkey", "o_totalprice", 0)
    return a.select("o_custkey", E.accepted(F.col("best"), F.col("runner_up"), 100000, 8000).alias("decision"))


@query("er_15_upsert", "SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN -1.0 ELSE s_acctbal END::DOUBLE AS s_acctbal, s_name FROM supplier UNION ALL SELECT 1000000, -1.0, NULL")
def _(t):
    old = t.supplier.select("s_suppkey", "s_acctbal", "s_name")
    new = old.where("s_suppkey % 5 = 0").select("s_suppkey", F.lit(-1.0).alias("s_acctbal")).union(t.spark.sql("select 1000000L, -1.0D"))
    return E.upserted(old, new, "s_suppkey", ["s_acctbal"])


@query("er_16_change_guard_failing", "SELECT count(*) AS changed FROM supplier WHERE s_suppkey % 5 = 0 AND s_suppkey % 2 <> 0 AND s_acctbal <> -1.0")
def _(t):
    old = t.supplier
    new = old.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 5 == 0, -1.0).otherwise(F.col("s_acctbal")))
    return E.unchanged(old, new, "s_suppkey", old.where("s_suppkey % 2 = 0")).agg(F.count("*").alias("changed"))


@query("er_16_change_guard", "SELECT count(*) AS changed FROM supplier WHERE false")
def _(t):
    old = t.supplier
    new = old.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 5 == 0, -1.0).otherwise(F.col("s_acctbal")))
    return E.unchanged(old, new, "s_suppkey", old.where("s_suppkey % 5 = 0")).agg(F.count("*").alias("changed"))


# ---- sources, sinks and streams
@query("src_12_pages", """WITH p AS (SELECT doc_id, string_split(text, '.') AS p FROM documents WHERE text IS NOT NULL), q AS (SELECT doc_id, CASE WHEN len(p) > 1 AND trim(p[-1]) = '' THEN p[:len(p) - 1] ELSE p END AS p FROM p)
SELECT doc_id, generate_subscripts(p, 1)::INT AS page, md5(unnest(p)) AS digest FROM q""")
def _(t):
    d = t.documents.select("doc_id", F.replace("text", F.lit("."), F.lit("\f")).alias("text"))
    return S.pages(d, "doc_id", "text").select("doc_id", "page", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("src_11_numbered_lines", "SELECT s_suppkey, 1 AS number, s_name AS item FROM supplier UNION ALL SELECT s_suppkey, 2, 'x' FROM supplier")
def _(t):
    return S.numbered_lines(t.supplier.select("s_suppkey", F.concat(F.lit("head\n 1. "), F.col("s_name"), F.lit(" \n2、x\nno 3")).alias("text")), "s_suppkey", "text")


@query("src_13_html_list", """WITH p AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?s)<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g'), '(?s)<(?:h[1-6]|li)\\b[^>]*>.*?</(?:h[1-6]|li)>') AS parts FROM pages), x AS (SELECT page_id, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS part FROM p),
s AS (SELECT *, last_value(CASE WHEN part LIKE '<h%' THEN regexp_replace(part, '<[^>]*>', '', 'g') END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM x) SELECT page_id, pos::INT AS pos, section, trim(regexp_replace(part, '<[^>]*>', '', 'g')) AS item FROM s WHERE part LIKE '<li%'""")
def _(t):
    return S.html_items(t.pages, "page_id", "html")


@query("src_15_inventory")
def _(t):
    return S.inventory(t.spark, f"{t.dir}/region.parquet").select("name", "size", "sha256", "type", "copies")


@query("src_20_cache", "SELECT o_orderkey, o_orderkey % 3 = 0 AS reused FROM orders")
def _(t):
    req = t.orders.select("o_orderkey", "o_custkey")
    cache = req.select(F.sha2(F.concat_ws("|", "o_orderkey", "o_custkey"), 256).alias("fingerprint"), F.when(F.col("o_orderkey") % 3 == 0, "ok").otherwise("failed").alias("status"), F.lit("a").alias("answer"))
    have, send = S.cached_requests(req, cache, ["o_orderkey", "o_custkey"])
    return have.select("o_orderkey", F.lit(True).alias("reused")).unionByName(send.select("o_orderkey", F.lit(False).alias("reused")))


@query("snk_01_csv_rows", "SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS active, s_name || ';b' AS tags, '' AS note FROM supplier")
def _(t):
    df = t.supplier.select(F.col("s_suppkey").alias("id"), (F.col("s_acctbal") > 0).alias("active"), F.array(F.col("s_name"), F.lit("b")).alias("tags"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("active", T.BooleanType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("note", T.StringType())])
    return K.csv_rows(df, schema)


@query("snk_03_features", """SELECT '{"type":"Feature","properties":{"n_nationkey":' || n_nationkey || '},"geometry":{"type":"Point","coordinates":[1.0,2.0]}}' AS value FROM nation""")
def _(t):
    return K.features(t.nation.withColumn("xy", F.array(F.lit(1.0), F.lit(2.0))), ["n_nationkey"], "Point", "xy")


@query("ext_windowed_events", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def _(t):
    return EV.windowed(t.events).withColumn("total", F.round("total", 6)).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
