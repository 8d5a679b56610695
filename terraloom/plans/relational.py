"""Relational plans: projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terraloom.operators import aggregates as A
from terraloom.operators import joins as J
from terraloom.operators import projection as P
from terraloom.operators import windows as W
from terraloom.plans.registry import query

def order_year():
    return F.year("o_orderdate")


@query("prj_01_declared_order", "SELECT n_name, n_nationkey::BIGINT AS n_nationkey, NULL::VARCHAR AS note FROM nation")
def _(t):
    return P.conform(t.nation, T.StructType([T.StructField("n_name", T.StringType()), T.StructField("n_nationkey", T.LongType()), T.StructField("note", T.StringType())]))


@query("prj_02_lineage", "SELECT s_suppkey, 'registry' AS data_source, '1.0' AS calculation_version, 30 AS resolution_m FROM supplier")
def _(t):
    return P.stamped(t.supplier.select("s_suppkey"), data_source="registry", calculation_version="1.0", resolution_m=30)


@query("prj_03_code_hierarchy", "SELECT c_custkey, substr(lpad((450000 + c_custkey % 1500)::VARCHAR, 6, '0'), 1, 4) || '00' AS city_adcode, '450000' AS province_adcode FROM customer")
def _(t):
    code = F.lpad((F.lit(450000) + F.col("c_custkey") % 1500).cast("string"), 6, "0")
    return t.customer.select("c_custkey", P.city_code(code).alias("city_adcode"), F.lit("450000").alias("province_adcode"))


@query("prj_04_lookup", "SELECT n_name, r_name FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) r ON n_regionkey = r_regionkey")
def _(t):
    r = t.region.where("r_regionkey < 3").withColumnRenamed("r_regionkey", "n_regionkey")
    return J.lookup(t.nation, r, "n_regionkey").select("n_name", "r_name")


@query("prj_05_rename", "SELECT p_size AS size_class, min(p_retailprice) AS price_min, max(p_retailprice) AS price_max FROM part GROUP BY 1")
def _(t):
    s = t.part.groupBy("p_size").agg(F.min("p_retailprice").alias("min"), F.max("p_retailprice").alias("max"))
    return s.withColumnsRenamed({"p_size": "size_class", "min": "price_min", "max": "price_max"})


@query("prj_06_keyed_concat", """SELECT o_custkey, a.total, b.n FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) a
JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) b USING (o_custkey)""")
def _(t):
    a = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    b = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return a.join(b, "o_custkey")


FLAGS = """CASE WHEN n = 0 THEN 'empty' WHEN area < 900 THEN 'sliver' WHEN NOT (ratio BETWEEN 0.8 AND 1.2) THEN 'review' ELSE 'pass' END"""


@query("prj_07_flag_ladder", f"""WITH z AS (SELECT p_partkey, count(l_quantity) AS n, coalesce(sum(l_quantity), 0) * 20 AS area FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1),
r AS (SELECT *, CASE WHEN area > 0 THEN n * 510 / area END AS ratio FROM z) SELECT p_partkey, n, area, ratio, {FLAGS} AS quality_flag FROM r""")
def _(t):
    z = t.part.select("p_partkey").join(t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity"), "p_partkey", "left").groupBy("p_partkey").agg(
        F.count("l_quantity").alias("n"), (F.coalesce(F.sum("l_quantity"), F.lit(0.0)) * 20).alias("area"))
    z = z.withColumn("ratio", P.safe_ratio(F.col("n") * 510, F.col("area")))
    return z.withColumn("quality_flag", P.coverage_flag(F.col("n"), F.col("area"), F.col("ratio")))


@query("prj_08_safe_ratio", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_tax / l_discount END AS ratio FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", P.safe_ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"))


@query("prj_09_finite", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events")
def _(t):
    x = F.when(F.col("event_id") % 14 == 0, F.lit(float("nan"))).when(F.col("event_id") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return t.events.select("event_id", P.finite(x).alias("value"))


@query("flt_01_equality", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    return t.customer.where(F.col("c_mktsegment") == "BUILDING")


@query("flt_02_conjunction", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 AND o_orderpriority LIKE '1%'")
def _(t):
    return t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000) & F.col("o_orderpriority").startswith("1")).select("o_orderkey")


@query("flt_03_semi", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def _(t):
    return t.supplier.join(t.nation.where("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("s_suppkey")


@query("flt_04_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def _(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("flt_05_tolerance", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE abs(l_discount - 0.05) <= 0.0101 AND l_quantity BETWEEN 10 AND 20")
def _(t):
    return t.lineitem.where((F.abs(F.col("l_discount") - 0.05) <= 0.0101) & F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_linenumber")


@query("flt_07_not_null", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").dropna(subset=["quality"]).select("doc_id", "quality")


@query("flt_08_code_set", "SELECT vec_id, label FROM embeddings WHERE label IN (1, 3, 5)")
def _(t):
    return t.embeddings.where(F.col("label").isin(1, 3, 5)).select("vec_id", "label")


@query("flt_09_full_match", "SELECT c_custkey FROM customer WHERE regexp_full_match(c_name, 'Customer#[0-9]*[13579]')")
def _(t):
    return t.customer.where(F.col("c_name").rlike("^Customer#[0-9]*[13579]$")).select("c_custkey")


@query("flt_10_class_list", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1")
def _(t):
    return t.events.where(F.col("event_type").isin("click", "view", "purchase")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("flt_11_subset_copy", "SELECT * FROM supplier WHERE s_nationkey = 3")
def _(t):
    return t.supplier.where("s_nationkey = 3")


@query("jn_01_one_to_one", "SELECT s_suppkey, s_name, total FROM supplier LEFT JOIN (SELECT l_suppkey AS s_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1) USING (s_suppkey)")
def _(t):
    totals = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").alias("total"))
    return J.one_to_one(t.supplier.select("s_suppkey", "s_name"), totals, "s_suppkey")


@query("jn_02_map_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    return J.lookup(t.customer, t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey").select("c_custkey", "n_name")


@query("jn_03_fill_zero", "SELECT c_custkey, coalesce(n, 0)::BIGINT AS n FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey)")
def _(t):
    return J.filled(t.customer.select("c_custkey"), t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")), "c_custkey", n=0)


@query("jn_04_semi_chain", """SELECT DISTINCT year(o_orderdate)::INT AS y, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2))""")
def _(t):
    n = t.nation.where("n_regionkey = 2")
    c = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(order_year().alias("y"), "o_orderkey")


@query("jn_05_set_difference", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem")
def _(t):
    return t.part.join(t.lineitem, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


def name_or_alias(t, customers):
    s = t.supplier.select("s_suppkey")
    c = customers.select("c_custkey")
    by_name = J.sized(s.select((F.col("s_suppkey")).alias("key"), F.col("s_suppkey").alias("by_name")))
    by_alias = J.sized(s.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_suppkey").alias("by_alias")))
    c = c.withColumn("key", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") * 3))
    return c.join(by_name, "key", "left").join(by_alias, "c_custkey", "left").select("c_custkey", F.coalesce("by_name", "by_alias").alias("s_suppkey"))


@query("jn_06_name_or_alias", """SELECT c_custkey, coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey FROM customer
LEFT JOIN supplier a ON a.s_suppkey = c_custkey * 3 AND c_custkey % 2 = 0 LEFT JOIN supplier b ON b.s_suppkey = c_custkey""")
def _(t):
    return name_or_alias(t, t.customer)


@query("jn_07_list_key_chain", """WITH x AS (SELECT o_orderkey, unnest(string_split(concat_ws(';', o_custkey::VARCHAR, (o_custkey + 100000)::VARCHAR), ';'))::BIGINT AS k FROM orders)
SELECT o_orderkey, k AS missing FROM x WHERE k NOT IN (SELECT c_custkey FROM customer)""")
def _(t):
    keys = F.concat_ws(";", F.col("o_custkey").cast("string"), (F.col("o_custkey") + 100000).cast("string"))
    x = t.orders.select("o_orderkey", F.explode(F.split(keys, ";")).alias("missing")).withColumn("missing", F.col("missing").cast("long"))
    return x.join(t.customer, F.col("missing") == F.col("c_custkey"), "left_anti")


LINKS = """SELECT l_partkey AS part, l_suppkey AS supp FROM lineitem WHERE l_quantity > 45"""


@query("jn_16_link_status", f"""WITH l AS ({LINKS}), p AS (SELECT part, count(DISTINCT supp) AS n, min(supp) AS one FROM l GROUP BY 1)
SELECT p_partkey AS part, CASE WHEN n = 1 THEN one END AS supp, coalesce(n, 0)::BIGINT AS n, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched_single' ELSE 'matched_multiple' END AS status
FROM part LEFT JOIN p ON p_partkey = part""")
def _(t):
    links = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
    return J.link_status(links, t.part.select(F.col("p_partkey").alias("part")), "part", "supp")


@query("jn_17_blocked_pairs", """SELECT a.s_suppkey AS "left", b.s_suppkey AS "right", 'same_nation_and_balance_band' AS reason FROM supplier a JOIN supplier b
ON a.s_nationkey = b.s_nationkey AND floor(a.s_acctbal / 1000) = floor(b.s_acctbal / 1000) AND a.s_suppkey < b.s_suppkey""")
def _(t):
    band = F.concat_ws("|", F.col("s_nationkey").cast("string"), F.floor(F.col("s_acctbal") / 1000).cast("string"))
    return J.blocked_pairs(t.supplier, "s_suppkey", {"same_nation_and_balance_band": band})


CALENDAR = """WITH cal AS (SELECT unnest(range(1994, 2004))::INT AS y), f AS (SELECT year(o_orderdate)::INT AS y, count(*) AS n FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1),
c AS (SELECT y, CASE WHEN y BETWEEN 1995 AND 2001 THEN 'available' ELSE 'missing' END AS status FROM cal)"""


@query("jn_18_coverage_calendar", f"{CALENDAR} SELECT y, status, CASE WHEN status = 'available' THEN coalesce(n, 0)::BIGINT END AS n FROM c LEFT JOIN f USING (y)")
def _(t):
    cal = t.spark.range(1994, 2004).select(F.col("id").cast("int").alias("y")).withColumn("status", F.when(F.col("y").between(1995, 2001), "available").otherwise("missing"))
    f = t.orders.where(F.col("o_orderpriority").startswith("1")).groupBy(order_year().alias("y")).agg(F.count("*").alias("n"))
    return cal.join(f, "y", "left").withColumn("n", F.when(F.col("status") == "available", F.coalesce("n", F.lit(0))))


@query("jn_19_densified_classes", """WITH k AS (SELECT n_nationkey FROM nation), s AS (SELECT DISTINCT c_mktsegment FROM customer), c AS (SELECT c_nationkey AS n_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY ALL)
SELECT n_nationkey, c_mktsegment, coalesce(n, 0)::BIGINT AS n FROM k CROSS JOIN s LEFT JOIN c USING (n_nationkey, c_mktsegment)""")
def _(t):
    counts = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count("*").alias("n"))
    return J.densified(t.nation.select("n_nationkey"), t.customer.select("c_mktsegment").distinct(), counts, ["n_nationkey", "c_mktsegment"], "n")


@query("jn_20_seam", """WITH x AS (SELECT p_partkey AS tile, p_retailprice AS v FROM part) SELECT count(*) AS n, max(abs(b.v - a.v)) AS max_diff, avg(abs(b.v - a.v)) AS mean_diff, avg(CASE WHEN a.v = b.v THEN 1.0 ELSE 0.0 END)::DOUBLE AS equal_ratio
FROM x a JOIN x b ON b.tile = a.tile + 1""")
def _(t):
    s = J.seam(t.part.select(F.col("p_partkey").alias("tile"), F.col("p_retailprice").alias("v")), "tile", 1, "v")
    return s.agg(F.count("*").alias("n"), F.max("diff").alias("max_diff"), F.avg("diff").alias("mean_diff"), F.avg(F.when(F.col("diff") == 0, 1.0).otherwise(0.0)).alias("equal_ratio"))


@query("jn_21_previous_state", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'O' END AS previous, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'O' END <> o_orderstatus, false) AS changed FROM orders""")
def _(t):
    prev = t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("O").alias("previous"))
    return t.orders.select("o_orderkey", "o_orderstatus").join(prev, "o_orderkey", "left").withColumn("changed", F.coalesce(F.col("previous") != F.col("o_orderstatus"), F.lit(False)))


@query("jn_22_case_assembly", """SELECT o_orderkey, c_name, n_name, lines FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return t.orders.join(lines, "o_orderkey", "left").join(c, "o_custkey", "left").join(J.sized(t.nation.select("n_nationkey", "n_name")), "n_nationkey", "left").select("o_orderkey", "c_name", "n_name", "lines")


@query("ag_01_sum", "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))


@query("ag_02_sum_nunique", "SELECT l_partkey, sum(l_quantity) AS area, count(DISTINCT l_suppkey) AS related FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("area"), F.countDistinct("l_suppkey").alias("related"))


@query("ag_03_group_size", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    return t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("ag_04_groups_over_one", "SELECT count(*) AS cells, count(*) FILTER (WHERE n > 1) AS shared FROM (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)")
def _(t):
    g = t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n"))
    return g.agg(F.count("*").alias("cells"), F.count_if(F.col("n") > 1).alias("shared"))


@query("ag_05_distribution", "SELECT coalesce(nullif(trim(CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE lang END), ''), '(blank)') AS value, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    return A.distribution(t.documents.select(F.when(F.col("doc_id") % 5 == 0, " ").otherwise(F.col("lang")).alias("v")), "v")


@query("ag_06_moments", "SELECT count(l_extendedprice) AS n, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS std, min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem")
def _(t):
    return t.lineitem.agg(*A.moments(F.col("l_extendedprice")))


@query("ag_07_zonal", "SELECT l_suppkey AS zone, count(l_quantity) AS n, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("zone")).agg(*A.moments(F.col("l_quantity")))


@query("ag_08_threshold_ratios", """SELECT p_partkey, avg(CASE WHEN q <= 3 THEN 1.0 WHEN q > 3 THEN 0.0 END)::DOUBLE AS le_3, avg(CASE WHEN q <= 5 THEN 1.0 WHEN q > 5 THEN 0.0 END)::DOUBLE AS le_5, avg(CASE WHEN q <= 8 THEN 1.0 WHEN q > 8 THEN 0.0 END)::DOUBLE AS le_8
FROM (SELECT p_partkey, l_quantity AS q FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber > 2) ON l_partkey = p_partkey) GROUP BY 1""")
def _(t):
    j = t.part.select("p_partkey").join(t.lineitem.where("l_linenumber > 2").select(F.col("l_partkey").alias("p_partkey"), "l_quantity"), "p_partkey", "left")
    return j.groupBy("p_partkey").agg(*[A.within_ratio(F.col("l_quantity"), k).alias(f"le_{k}") for k in (3, 5, 8)])


@query("ag_09_class_histogram", "SELECT l_suppkey AS zone, l_returnflag AS class, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("zone"), F.col("l_returnflag").alias("class")).agg(F.count("*").alias("n"))


@query("ag_10_cell_accumulation", "SELECT floor(l_extendedprice / 1000)::BIGINT AS col, floor(l_quantity / 5)::BIGINT AS row, count(*) AS pixels, sum(l_tax) AS total FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.floor(F.col("l_extendedprice") / 1000).alias("col"), F.floor(F.col("l_quantity") / 5).alias("row")).agg(F.count("*").alias("pixels"), F.sum("l_tax").alias("total"))


@query("ag_11_dominant_class", """WITH c AS (SELECT o_custkey, o_orderpriority AS cls, count(*) AS n FROM orders GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, cls) AS r FROM c)
SELECT o_custkey, cls AS dominant, n AS count FROM r WHERE r = 1""")
def _(t):
    return A.dominant(t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("cls")).agg(F.count("*").alias("n")), "o_custkey", "cls", "n")


@query("ag_12_wide_ratios", "SELECT l_suppkey, " + ", ".join(f"(count(*) FILTER (WHERE l_returnflag = '{v}'))::DOUBLE / count(*) AS ratio_{i}" for i, v in enumerate("ANR")) + " FROM lineitem GROUP BY 1")
def _(t):
    return A.wide_ratios(t.lineitem, "l_suppkey", "l_returnflag", ["A", "N", "R"], "ratio_")


@query("ag_13_transition_matrix", "SELECT o_orderstatus AS a, l_linestatus AS b, count(*) AS n, sum(CASE WHEN o_orderstatus <> l_linestatus THEN 1 ELSE 0 END)::BIGINT AS conflicts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def _(t):
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy(F.col("o_orderstatus").alias("a"), F.col("l_linestatus").alias("b")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("o_orderstatus") != F.col("l_linestatus"), 1).otherwise(0)).alias("conflicts"))


@query("ag_14_mode", """WITH c AS (SELECT user_id, event_type AS v, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, length(v) DESC, v) AS r FROM c) SELECT user_id, v AS mode, n FROM r WHERE r = 1""")
def _(t):
    return A.most_frequent(t.events, "user_id", "event_type")


@query("ag_15_unique_join", """WITH f AS (SELECT user_id, event_type, min(event_id) AS s FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type, ';' ORDER BY s) AS kinds FROM f GROUP BY 1""")
def _(t):
    return t.events.groupBy("user_id").agg(A.unique_join(F.col("event_id"), F.col("event_type")).alias("kinds"))


@query("ag_16_any_all", "SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_f, bool_and(o_totalprice > 1000) AS all_large FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("any_f"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_large"))


@query("ag_17_custom_priority", "SELECT user_id, arg_min(event_type, lpad(coalesce(list_position(['purchase', 'click', 'view'], event_type), 1000)::VARCHAR, 5, '0') || event_type) AS first_kind FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(A.by_priority(F.col("event_type"), ["purchase", "click", "view"]).alias("first_kind"))


@query("ag_18_scored_choice", """WITH c AS (SELECT p_brand, p_type, count(*) AS n, CASE WHEN p_type LIKE '%STEEL%' OR p_type LIKE '%BRASS%' THEN 1 ELSE 0 END AS f FROM part GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY f DESC, n DESC, length(p_type) DESC, p_type) AS r FROM c) SELECT p_brand, p_type AS chosen FROM r WHERE r = 1""")
def _(t):
    c = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    facility = F.when(F.col("p_type").rlike("STEEL|BRASS"), 1).otherwise(0)
    return J.latest(c, "p_brand", facility.desc(), F.desc("n"), F.length("p_type").desc(), F.asc("p_type")).select("p_brand", F.col("p_type").alias("chosen"))


@query("ag_19_describe", "SELECT avg(o_totalprice) AS mean, round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.95), 4) AS p95, max(o_totalprice) AS max FROM orders")
def _(t):
    x = F.col("o_totalprice")
    return t.orders.agg(F.avg(x).alias("mean"), F.round(F.percentile(x, F.lit(0.5)), 4).alias("median"), F.round(F.percentile(x, F.lit(0.95)), 4).alias("p95"), F.max(x).alias("max"))


@query("ag_20_arg_max", "SELECT o_orderkey AS at, o_totalprice AS worst FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def _(t):
    return t.orders.agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("at"), F.max("o_totalprice").alias("worst"))


@query("ag_22_area_weighted_mean", "SELECT l_partkey, sum(l_extendedprice * l_quantity) / sum(l_quantity) AS mean FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(A.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")).alias("mean"))


@query("ag_23_observed_coverage", """SELECT l_suppkey, sum(CASE WHEN l_linenumber <> 7 THEN l_quantity ELSE 0 END) AS observed, sum(l_quantity) AS total, sum(CASE WHEN l_linenumber <> 7 THEN l_quantity ELSE 0 END) / sum(l_quantity) AS coverage,
sum(CASE WHEN l_linenumber <> 7 THEN l_quantity * l_discount ELSE 0 END) AS affected FROM lineitem GROUP BY 1""")
def _(t):
    seen = F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).otherwise(0.0)
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(seen).alias("observed"), F.sum("l_quantity").alias("total"), (F.sum(seen) / F.sum("l_quantity")).alias("coverage"), F.sum(seen * F.col("l_discount")).alias("affected"))


@query("ag_24_affected_sums", "SELECT n_nationkey, coalesce(count(c_custkey), 0) AS affected, coalesce(sum(c_acctbal), 0) / 1000 AS km FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9500) ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    hit = t.customer.where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("affected"), (F.sum("c_acctbal") / 1000).alias("km"))
    return J.filled(t.nation.select("n_nationkey"), hit, "n_nationkey", affected=0, km=0.0)


@query("ag_25_presence", "SELECT c_custkey, min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year, count(DISTINCT year(o_orderdate)) AS years FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    j = t.customer.select("c_custkey").join(t.orders.select(F.col("o_custkey").alias("c_custkey"), order_year().alias("y")), "c_custkey", "left")
    return j.groupBy("c_custkey").agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.countDistinct("y").alias("years"))


@query("ag_26_top_values", """WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS r FROM c)
SELECT p_brand, string_agg(p_size::VARCHAR || ':' || n::VARCHAR, ',' ORDER BY r) AS top FROM r WHERE r <= 8 GROUP BY 1""")
def _(t):
    c = t.part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    k = W.top_k(c, "p_brand", 8, F.desc("n"), F.asc("p_size"))
    return k.groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rk", F.concat_ws(":", "p_size", "n").alias("s")))), lambda x: x["s"]), ",").alias("top"))


@query("ag_27_ordered_list", "SELECT conv_id, string_agg(role, '>' ORDER BY turn, role) AS roles FROM conversations GROUP BY 1")
def _(t):
    return t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">").alias("roles"))


@query("ag_28_coarse_grid", "SELECT floor(c_acctbal / 500)::BIGINT AS cx, floor(c_nationkey / 5)::BIGINT AS cy, sum(c_acctbal) AS total, avg(c_acctbal) AS mean, min(c_acctbal) AS low, max(c_acctbal) AS high, avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END)::DOUBLE AS built_ratio FROM customer GROUP BY ALL")
def _(t):
    x = F.col("c_acctbal")
    return t.customer.groupBy(F.floor(x / 500).alias("cx"), F.floor(F.col("c_nationkey") / 5).alias("cy")).agg(F.sum(x).alias("total"), F.avg(x).alias("mean"), F.min(x).alias("low"), F.max(x).alias("high"), F.avg(F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0)).alias("built_ratio"))


@query("ag_29_unit_conversion", "SELECT s_suppkey, s_acctbal * 100 AS hectares, s_acctbal - s_acctbal * 0.25 - s_acctbal * 0.5 AS residual FROM supplier")
def _(t):
    x = F.col("s_acctbal")
    return t.supplier.select("s_suppkey", (x * 100).alias("hectares"), (x - x * 0.25 - x * 0.5).alias("residual"))


@query("wn_01_primary_label", "WITH g AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS a FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY a DESC, l_suppkey) AS r FROM g) SELECT l_partkey, l_suppkey AS primary_supp, a FROM r WHERE r = 1")
def _(t):
    g = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("a"))
    best = g.groupBy("l_partkey").agg(F.max_by(F.struct("l_suppkey", "a"), F.struct("a", -F.col("l_suppkey"))).alias("m"))
    return best.select("l_partkey", F.col("m.l_suppkey").alias("primary_supp"), "m.a")


@query("wn_02_sequence_in_parent", "SELECT o_custkey, o_orderkey, 'ADMIN_' || o_custkey || '_' || lpad((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::VARCHAR, 3, '0') AS child_id FROM orders")
def _(t):
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t.orders.select("o_custkey", "o_orderkey", F.concat(F.lit("ADMIN_"), F.col("o_custkey").cast("string"), F.lit("_"), F.lpad(n.cast("string"), 3, "0")).alias("child_id"))


@query("wn_03_sequential_rank", "SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS rank FROM supplier")
def _(t):
    from terraloom.operators.ranking import global_row_number

    return global_row_number(t.supplier.select("s_suppkey", "s_acctbal"), "rank", F.asc("s_acctbal"), F.asc("s_suppkey")).select("s_suppkey", "rank")


@query("wn_05_min_max", "SELECT s_suppkey, (s_acctbal - min(s_acctbal) OVER ()) / (max(s_acctbal) OVER () - min(s_acctbal) OVER ()) AS s_acctbal_norm FROM supplier")
def _(t):
    return W.min_max(t.supplier, ["s_acctbal"]).select("s_suppkey", "s_acctbal_norm")


@query("wn_07_level_delta", "SELECT event_id, user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta FROM events")
def _(t):
    return t.events.select("event_id", "user_id", W.delta("value", "user_id", "ts", "event_id").alias("delta"))


@query("wn_08_backfill", """WITH x AS (SELECT event_id, user_id, ts, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM events)
SELECT event_id, coalesce(v, lead(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) - lead(d) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS level FROM x""")
def _(t):
    x = t.events.withColumn("d", W.delta("value", "user_id", "ts", "event_id")).withColumn("v", F.when(F.col("event_id") % 5 != 0, F.col("value")))
    return x.select("event_id", W.backfilled("v", "d", "user_id", "ts", "event_id").alias("level"))


@query("wn_09_sticky_header", "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN substr(text, 1, 20) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) AS header FROM conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", "role", W.sticky(F.when(F.col("role") == "user", F.substring("text", 1, 20)), "conv_id", "turn", "role").alias("header"))


@query("wn_10_runner_up", """WITH r AS (SELECT o_custkey, o_totalprice AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS r, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS n FROM orders)
SELECT o_custkey, s AS best, n AS runner_up, coalesce(s - n < 10000, false) AS ambiguous FROM r WHERE r = 1""")
def _(t):
    return W.ambiguous(t.orders, "o_custkey", "o_totalprice", 10000)


@query("wn_11_duplicate_flags", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_type, p_size) > 1 AS duplicated FROM part")
def _(t):
    return t.part.select("p_partkey", (F.count("*").over(Window.partitionBy("p_brand", "p_type", "p_size")) > 1).alias("duplicated"))


@query("wn_12_sortedness", "SELECT user_id, bool_and(coalesce(ts >= p, true)) AS is_sorted FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY 1")
def _(t):
    x = t.events.withColumn("p", F.lag("ts").over(Window.partitionBy("user_id").orderBy("event_id")))
    return x.groupBy("user_id").agg(F.bool_and(F.coalesce(F.col("ts") >= F.col("p"), F.lit(True))).alias("is_sorted"))


@query("wn_13_conflict_clear", "SELECT s_suppkey, CASE WHEN count(*) OVER (PARTITION BY s_nationkey, floor(s_acctbal / 2000)) = 1 THEN s_nationkey END AS chosen FROM supplier")
def _(t):
    n = F.count("*").over(Window.partitionBy("s_nationkey", F.floor(F.col("s_acctbal") / 2000)))
    return t.supplier.select("s_suppkey", F.when(n == 1, F.col("s_nationkey")).alias("chosen"))


@query("wn_14_capacity_allocation", """WITH d AS (SELECT o_orderkey, o_custkey, floor(o_totalprice)::BIGINT AS need, o_orderpriority FROM orders), x AS (SELECT *, sum(need) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey ROWS UNBOUNDED PRECEDING) - need AS before FROM d)
SELECT o_orderkey, greatest(0, least(need, 500000 - before))::BIGINT AS allocated, greatest(0, 500000 - before - greatest(0, least(need, 500000 - before)))::BIGINT AS remaining FROM x""")
def _(t):
    d = t.orders.withColumn("need", F.floor("o_totalprice"))
    got, left = W.allocate(F.col("need"), F.lit(500000).cast("long"), "o_custkey", "o_orderpriority", "o_orderkey")
    return d.select("o_orderkey", got.alias("allocated"), left.alias("remaining"))


def mixed_sort(lines):
    return lines.select("l_orderkey", "l_linenumber", "l_quantity").orderBy(F.desc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber"))


@query("so_01_mixed_sort", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return mixed_sort(t.lineitem)


@query("so_02_computed_sort", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS pr FROM orders")
def _(t):
    pr = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return t.orders.select("o_orderkey", pr.alias("pr")).orderBy("pr", "o_orderkey")


@query("so_03_top_k_per_entity", "WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM orders) SELECT * FROM r WHERE rk <= 5")
def _(t):
    return W.top_k(t.orders, "o_custkey", 5, F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_custkey", "o_orderkey", "rk")


@query("so_04_most_common", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def _(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("so_05_extremes", "SELECT arg_min(s_suppkey, s_acctbal) AS west, arg_max(s_suppkey, s_acctbal) AS east FROM supplier")
def _(t):
    return t.supplier.agg(F.min_by("s_suppkey", "s_acctbal").alias("west"), F.max_by("s_suppkey", "s_acctbal").alias("east"))


@query("so_06_constrained_minimum", "SELECT arg_min(s_suppkey, s_acctbal) AS chosen, count(*) AS eligible FROM supplier WHERE s_acctbal > 0 AND s_nationkey < 10")
def _(t):
    return t.supplier.where("s_acctbal > 0 and s_nationkey < 10").agg(F.min_by("s_suppkey", "s_acctbal").alias("chosen"), F.count("*").alias("eligible"))


@query("se_01_difference_both_ways", "SELECT k, 'missing' AS side FROM (SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem) UNION ALL SELECT k, 'unexpected' FROM (SELECT l_partkey AS k FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0)")
def _(t):
    parts, used = t.part.select(F.col("p_partkey").alias("k")), t.lineitem.select(F.col("l_partkey").alias("k"))
    return parts.subtract(used).withColumn("side", F.lit("missing")).unionByName(used.subtract(parts.where("k % 10 <> 0")).withColumn("side", F.lit("unexpected")))


@query("se_02_set_equality", "SELECT (SELECT count(*) FROM (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)) + (SELECT count(*) FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation)) = 0 AS equal")
def _(t):
    a, b = t.nation.select(F.col("n_nationkey").alias("k")).distinct(), t.supplier.select(F.col("s_nationkey").alias("k")).distinct()
    odd = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "k", "full").where("a is null or b is null")
    return odd.agg((F.count("*") == 0).alias("equal"))


@query("se_03_subset", "SELECT count(*) = 0 AS subset FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg((F.count("*") == 0).alias("subset"))


@query("se_04_union_keys", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("se_05_intersection", "SELECT c_custkey AS k FROM customer INTERSECT SELECT s_suppkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("k")).intersect(t.supplier.select("s_suppkey"))


@query("se_06_union_rows", "SELECT c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier")
def _(t):
    return t.customer.select(F.col("c_name").alias("name"), F.lit("customer").alias("kind")).unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("se_07_ordered_dedupe", "SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: list_position(ws, x[1]) = x[2]), lambda x: x[1]), ' ') AS kept FROM (SELECT doc_id, list_slice(string_split(text, ' '), 1, 40) AS ws FROM documents)")
def _(t):
    return t.documents.select("doc_id", F.array_join(F.array_distinct(F.slice(F.split("text", " "), 1, 40)), " ").alias("kept"))


@query("se_08_composite_distinct", "SELECT count(DISTINCT (l_partkey, l_suppkey)) AS n, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS repeats FROM lineitem")
def _(t):
    return t.lineitem.agg(F.countDistinct("l_partkey", "l_suppkey").alias("n"), (F.count("*") - F.countDistinct("l_partkey", "l_suppkey")).alias("repeats"))


@query("se_09_best_per_key", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) SELECT o_custkey, o_orderpriority, o_orderkey FROM r WHERE r = 1")
def _(t):
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("o_orderkey"))
