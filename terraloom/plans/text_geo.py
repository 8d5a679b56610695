"""Plans over texts, dates, numbers, arrays, JSON and coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.functions import geo as G
from terraloom.functions import text as X
from terraloom.operators import joins as J
from terraloom.operators import projection as P
from terraloom.plans.registry import query

WORDS = ["tion", "quell", "sch", "erthe"]
LIST = "['" + "', '".join(WORDS) + "']"


@query("flt_06_keyword_filter", f"SELECT doc_id FROM documents WHERE contains(text, ' the ') AND len(list_filter({LIST}, lambda w: contains(text, w))) > 0")
def _(t):
    return t.documents.where(F.contains("text", F.lit(" the ")) & X.contains_any(F.col("text"), WORDS)).select("doc_id")


@query("st_01_clean_cell", "SELECT doc_id, md5(regexp_replace(text, '\\s+', '', 'g')) AS cell FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(X.clean_cell(F.col("text")).cast("binary")).alias("cell"))


@query("st_01_nfkc")
def _(t):
    return t.documents.select("doc_id", F.length(X.nfkc(F.col("text"))).alias("n"))


@query("st_02_clean_text", r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS txt FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(X.clean_text(F.col("text")).cast("binary")).alias("txt"))


@query("st_03_normalize_name", "SELECT s_suppkey, '[' || s_suppkey || '](' || regexp_replace(s_name, '\\s+', '', 'g') || ')' AS name FROM supplier")
def _(t):
    raw = F.concat(F.lit("【"), F.col("s_suppkey").cast("string"), F.lit("】 （"), F.col("s_name"), F.lit("）"))
    return t.supplier.select("s_suppkey", X.normalize_name(raw).alias("name"))


@query("st_04_aliases", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'A' || c_custkey || ';B' ELSE '' END AS aliases FROM customer")
def _(t):
    k = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("X(formerly: A"), k, F.lit("; B)"))).otherwise(F.concat(F.lit("X("), k, F.lit(")")))
    return t.customer.select("c_custkey", F.array_join(X.explicit_aliases(raw), ";").alias("aliases"))


CODE = "upper(substr(md5(c_custkey::VARCHAR), 1, 18))"


@query("st_05_06_credit_code", f"SELECT c_custkey, {CODE} AS code, true AS groupable, regexp_full_match({CODE}, '[0-9A-HJ-NPQRTUWXY]{{18}}') AS valid FROM customer")
def _(t):
    code = X.credit_code(F.concat(F.substring(F.md5(F.col("c_custkey").cast("string").cast("binary")), 1, 18), F.lit(" -")))
    return t.customer.select("c_custkey", code.alias("code")).withColumns({"groupable": X.groupable_code(F.col("code")), "valid": X.valid_code(F.col("code"))})


@query("st_07_stable_id", "SELECT c_custkey, 'cand_' || substr(sha1(c_name || chr(31) || c_mktsegment || chr(31)), 1, 16) AS id FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.stable_id("cand", F.col("c_name"), F.col("c_mktsegment"), F.lit(None)).alias("id"))


@query("st_08_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))


@query("st_09_classification", "SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'metal' WHEN contains(p_type, 'BRASS') THEN 'alloy' WHEN regexp_matches(p_type, '^PROMO') THEN 'promo' ELSE 'other' END AS category FROM part")
def _(t):
    x = F.col("p_type")
    return t.part.select("p_partkey", P.ladder((F.contains(x, F.lit("STEEL")), "metal"), (F.contains(x, F.lit("BRASS")), "alloy"), (x.rlike("^PROMO"), "promo"), otherwise="other").alias("category"))


REGIONS = [("R1", "C1", "Customer#00000001"), ("R1", "C2", "Customer#00000002"), ("R2", "Customer", "")]


@query("st_10_region", """SELECT c_custkey, CASE WHEN contains(c_name, 'Customer#00000001') THEN 'R1/C1' WHEN contains(c_name, 'Customer#00000002') THEN 'R1/C2' WHEN contains(c_name, 'Customer') THEN 'R2/Customer' END AS region FROM customer""")
def _(t):
    r = X.region_of(F.col("c_name"), REGIONS)
    return t.customer.select("c_custkey", F.concat_ws("/", r["province"], r["city"]).alias("region")).withColumn("region", F.nullif("region", F.lit("")))


NAMES = ["南宁粮食储备库", "甲农产品批发市场", "某蔬菜稳产保供基地", "乙超市", "丙配送有限公司", "无名"]


def pick():
    """One of NAMES for each supplier."""
    return F.element_at(F.array(*[F.lit(x) for x in NAMES]), (F.col("s_suppkey") % 6 + 1).cast("int"))


@query("st_12_entity_type", "SELECT s_suppkey, (['physical_site', 'market', 'base', 'outlet', 'organization', 'unknown'])[(s_suppkey % 6 + 1)::INT] AS kind FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", X.entity_type(pick(), F.lit("")).alias("kind"))


@query("st_11_16_levels", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'reserve' ELSE 'external' END AS priority,
CASE WHEN s_suppkey % 3 = 0 THEN 'A' WHEN s_suppkey % 3 = 1 THEN CASE WHEN s_suppkey % 6 = 0 THEN 'A' ELSE 'B' END ELSE 'C' END AS level FROM supplier""")
def _(t):
    k = F.col("s_suppkey")
    city = F.when(k % 4 == 0, "南宁市").when(k % 4 == 1, "柳州市").otherwise("x")
    province = F.when(k % 4 == 2, "广西壮族自治区").otherwise("y")
    cat = F.when(k % 3 == 0, "cold_chain").when(k % 3 == 1, "grain_storage").otherwise("government_procurement")
    return t.supplier.select("s_suppkey", X.analysis_priority(province, city).alias("priority"), X.evidence_level(cat, F.lit("x"), pick()).alias("level"))


@query("st_14_15_flags", "SELECT s_suppkey, s_suppkey % 6 = 0 AS grain, s_suppkey % 6 = 2 AS vegetable, s_suppkey % 6 = 2 AS fresh_food, s_suppkey % 6 = 0 AS storage_capability, s_suppkey % 6 = 4 AS distribution_capability, s_suppkey % 6 = 3 AS retail_capability FROM supplier")
def _(t):
    f, c = X.product_flags(pick()), X.capability_flags(pick(), F.lit(""))
    return t.supplier.select("s_suppkey", *[f[k].alias(k) for k in ("grain", "vegetable", "fresh_food")], *[c[k].alias(k) for k in ("storage_capability", "distribution_capability", "retail_capability")])


@query("st_17_parent", "SELECT p_partkey, regexp_extract(p_type, '^(\\S+ \\S+) (\\S+)$', 1) AS parent, regexp_extract(p_type, '^(\\S+ \\S+) (\\S+)$', 2) AS unit FROM part")
def _(t):
    return t.part.select("p_partkey", F.regexp_extract("p_type", r"^(\S+ \S+) (\S+)$", 1).alias("parent"), F.regexp_extract("p_type", r"^(\S+ \S+) (\S+)$", 2).alias("unit"))


@query("st_18_trailing_code", "SELECT o_orderkey, right(lpad(o_orderkey::VARCHAR, 9, '1'), 6) AS code FROM orders")
def _(t):
    return t.orders.select("o_orderkey", X.six_digit_code(F.concat(F.lpad(F.col("o_orderkey").cast("string"), 9, "1"), F.lit(".0"))).alias("code"))


@query("st_19_name_similarity")
def _(t):
    names = t.supplier.select("s_suppkey", X.match_name(F.col("s_name")).alias("name"), "s_nationkey")
    pairs = J.pairs_within(names, "s_nationkey", "s_suppkey")
    return pairs.select(F.col("l_s_suppkey").alias("a"), F.col("r_s_suppkey").alias("b"), X.match_similarity(F.col("l_name"), F.col("r_name")).alias("similarity"))


@query("st_21_detailed_address", "SELECT s_suppkey, s_suppkey % 2 = 0 AS detailed FROM supplier")
def _(t):
    a = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("广西南宁市人民东路"), F.col("s_suppkey").cast("string"), F.lit("号"))).otherwise("广西南宁市")
    return t.supplier.select("s_suppkey", X.detailed_address(a, F.lit("南宁市"), F.lit(None).cast("string")).alias("detailed"))


@query("st_22_search_names", "SELECT s_suppkey, '南宁市' || s_suppkey || '有限公司|南宁市' || s_suppkey || '|' || s_suppkey AS names FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.array_join(X.search_names(F.concat(F.lit("南宁市"), F.col("s_suppkey").cast("string"), F.lit("有限公司"))), "|").alias("names"))


@query("st_23_address_parts", "SELECT s_suppkey, 'Old-' || s_suppkey || '-road' AS street, (s_suppkey * 2)::VARCHAR AS number FROM supplier")
def _(t):
    p = X.address_parts(F.concat(F.lit("Old-"), F.col("s_suppkey").cast("string"), F.lit("-road "), (F.col("s_suppkey") * 2).cast("string")))
    return t.supplier.select("s_suppkey", p["street"].alias("street"), p["number"].alias("number"))


@query("st_24_snippet", "SELECT doc_id, CASE WHEN instr(text, 'erthe') > 0 THEN substr(text, greatest(instr(text, 'erthe') - 60, 1), 180) ELSE '' END AS snip FROM documents")
def _(t):
    return t.documents.select("doc_id", X.snippet(F.col("text"), "erthe").alias("snip"))


@query("st_25_occurrences", "SELECT doc_id, ((length(text) - length(replace(text, 'tion', ''))) // 4)::BIGINT AS n FROM documents")
def _(t):
    return t.documents.select("doc_id", X.occurrences(F.col("text"), "tion").alias("n"))


@query("st_26_matched_keywords", f"SELECT doc_id, array_to_string(list_filter({LIST}, lambda w: contains(text, w)), '|') AS hits FROM documents")
def _(t):
    return t.documents.select("doc_id", X.matched_keywords(F.col("text"), WORDS).alias("hits"))


@query("st_27_anchor", "SELECT doc_id, contains(regexp_replace(text, '\\s+', '', 'g'), 'thethat') AS anchored FROM documents")
def _(t):
    return t.documents.select("doc_id", X.anchored(F.col("text"), F.lit("the\n that")).alias("anchored"))


@query("st_28_location", "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN printf('%.6f,%.6f', (c_custkey % 180)::DOUBLE, (c_custkey % 90)::DOUBLE) END AS location FROM customer")
def _(t):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, "181,95").otherwise(F.concat((k % 180).cast("string"), F.lit(","), (k % 90).cast("string")))
    return t.customer.select("c_custkey", X.location_text(raw).alias("location"))


@query("st_29_rgba", "SELECT n_nationkey, (n_nationkey * 10 % 256)::INT AS r, 255 AS a FROM nation")
def _(t):
    c = X.rgba(F.concat(F.lit("#"), F.lpad(F.lower(F.hex(F.col("n_nationkey") * 10 % 256)), 2, "0"), F.lit("0000")))
    return t.nation.select("n_nationkey", c[0].alias("r"), c[3].alias("a"))


@query("st_30_tile_name", "SELECT n_nationkey, (n_nationkey - 10)::INT AS lat, (100 + n_nationkey)::INT AS lon FROM nation")
def _(t):
    k = F.col("n_nationkey") - 10
    name = F.concat(F.when(k < 0, "S").otherwise("N"), F.lpad(F.abs(k).cast("string"), 2, "0"), F.lit("E"), F.lpad((F.col("n_nationkey") + 100).cast("string"), 3, "0"))
    lat, lon = X.tile_corner(name)
    return t.nation.select("n_nationkey", lat.alias("lat"), lon.alias("lon"))


@query("st_31_record_id", "SELECT s_suppkey, 'osm:' || s_nationkey || ':' || s_suppkey AS record_id FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.concat_ws(":", F.lit("osm"), "s_nationkey", "s_suppkey").alias("record_id"))


@query("st_32_chainage", "SELECT s_suppkey, s_suppkey * 1000 + s_suppkey % 1000 AS metres FROM supplier")
def _(t):
    k = F.col("s_suppkey")
    return t.supplier.select("s_suppkey", X.chainage_m(F.concat(F.lit("K"), k.cast("string"), F.lit("+"), F.lpad((k % 1000).cast("string"), 3, "0"))).alias("metres"))


@query("st_33_key_values", "SELECT s_suppkey, s_name AS title, 'a:b' AS note FROM supplier")
def _(t):
    m = X.key_values(F.concat(F.lit("Title: "), F.col("s_name"), F.lit("\nNote: a:b\n")))
    return t.supplier.select("s_suppkey", m["Title"].alias("title"), m["Note"].alias("note"))


@query("st_34_checksum_list", "SELECT s_suppkey, md5(s_name) AS hash, s_name || '.csv' AS path FROM supplier")
def _(t):
    h, p = X.checksum_line(F.concat(F.upper(F.md5(F.col("s_name").cast("binary"))), F.lit("  *"), F.col("s_name"), F.lit(".csv")))
    return t.supplier.select("s_suppkey", h.alias("hash"), p.alias("path"))


@query("st_36_leak_scan", "SELECT doc_id, contains(text, 'AKIA') AS leaked FROM documents")
def _(t):
    return t.documents.select("doc_id", F.contains("text", F.lit("AKIA")).alias("leaked"))


@query("dt_01_compact_dates", "SELECT min(o_orderdate)::DATE AS first, max(o_orderdate)::DATE AS last, count(*) AS n, 0::BIGINT AS bad FROM orders")
def _(t):
    d = F.try_to_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd")
    return t.orders.agg(F.min(d).alias("first"), F.max(d).alias("last"), F.count("*").alias("n"), F.count_if(d.isNull()).alias("bad"))


@query("dt_02_year", "SELECT o_orderkey, year(o_orderdate)::INT AS y FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))


@query("dt_03_metadata_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _(t):
    raw = F.concat(F.lit("D:"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("120000+08"))
    p = r"D:([0-9]{4})([0-9]{2})([0-9]{2})"
    return t.orders.select("o_orderkey", F.concat_ws("-", *[F.regexp_extract(raw, p, i) for i in (1, 2, 3)]).alias("day"))


@query("dt_04_calendar", "SELECT unnest(range(2016, 2026))::INT AS y")
def _(t):
    return t.spark.range(1).select(F.explode(F.sequence(F.lit(2016), F.lit(2025))).alias("y"))


@query("ma_01_snap", "SELECT s_suppkey, floor(s_acctbal / 30) * 30 AS lo, ceil(s_acctbal / 30) * 30 AS hi FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", G.snap(F.col("s_acctbal"), 30.0).cast("double").alias("lo"), G.snap(F.col("s_acctbal"), 30.0, up=True).cast("double").alias("hi"))


@query("ma_02_elementary", "SELECT s_suppkey, round(sqrt(s_acctbal * s_acctbal + 9), 6) AS h, round(degrees(atan(s_acctbal / 1000)), 6) AS slope FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.round(F.hypot(F.col("s_acctbal"), F.lit(3.0)), 6).alias("h"), F.round(F.degrees(F.atan(F.col("s_acctbal") / 1000)), 6).alias("slope"))


@query("ma_03_composite_score", "SELECT s_suppkey, round(0.35 * s_suppkey + 0.35 * s_nationkey + 0.2 * (s_suppkey % 7) + 0.1 * (s_suppkey % 3) + CASE WHEN s_acctbal < 0 THEN 100 ELSE 0 END, 6)::DOUBLE AS score FROM supplier")
def _(t):
    k = F.col("s_suppkey")
    return t.supplier.select("s_suppkey", F.round(0.35 * k + 0.35 * F.col("s_nationkey") + 0.2 * (k % 7) + 0.1 * (k % 3) + F.when(F.col("s_acctbal") < 0, 100.0).otherwise(0.0), 6).alias("score"))


@query("ma_04_half_even", "SELECT p_partkey, round_even(p_size::DOUBLE / 2, 0) AS half FROM part")
def _(t):
    return t.part.select("p_partkey", F.bround(F.col("p_size") / 2, 0).alias("half"))


@query("ma_05_relative_error", "SELECT s_suppkey, abs(s_acctbal - 5000) / greatest(abs(s_acctbal), 1e-30) AS rel FROM supplier")
def _(t):
    x = F.col("s_acctbal")
    return t.supplier.select("s_suppkey", (F.abs(x - 5000) / F.greatest(F.abs(x), F.lit(1e-30))).alias("rel"))


@query("ma_06_near_full", "SELECT s_suppkey, CASE WHEN abs(a - 1000000) <= 0.01 THEN 1000000.0 ELSE a END::DOUBLE AS area FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 1000000.005 ELSE 999999.9 END::DOUBLE AS a FROM supplier)")
def _(t):
    return t.supplier.select("s_suppkey", P.near_full(F.when(F.col("s_suppkey") % 2 == 0, 1000000.005).otherwise(999999.9)).alias("area"))


@query("ma_07_ceil_demand", "SELECT c_custkey, ceil(c_acctbal)::BIGINT AS people, (ceil(c_acctbal) * 3)::BIGINT AS days3 FROM customer WHERE c_acctbal > 0")
def _(t):
    return t.customer.where("c_acctbal > 0").select("c_custkey", F.ceil("c_acctbal").alias("people"), (F.ceil("c_acctbal") * 3).alias("days3"))


@query("ar_01_any_all", "SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: length(w) > 12)) > 0 AS any_long, len(list_filter(string_split(text, ' '), lambda w: length(w) = 0)) = 0 AS all_full FROM documents")
def _(t):
    w = F.split("text", " ")
    return t.documents.select("doc_id", F.exists(w, lambda x: F.length(x) > 12).alias("any_long"), F.forall(w, lambda x: F.length(x) > 0).alias("all_full"))


@query("ar_02_compact_join", "SELECT c_custkey, concat_ws(';', CASE WHEN c_custkey % 2 = 0 THEN c_name END, c_mktsegment) AS s FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.array_join(F.array_compact(F.array(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")), F.col("c_mktsegment"))), ";").alias("s"))


@query("ar_03_slice", "SELECT doc_id, array_to_string(list_slice(string_split(text, ' '), 1, 5), ' ') AS head FROM documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(F.slice(F.split("text", " "), 1, 5), " ").alias("head"))


@query("js_01_encode", """SELECT s_suppkey, '[{"id":' || s_suppkey || ',"n":"' || s_name || '"}]' AS js FROM supplier""")
def _(t):
    return t.supplier.select("s_suppkey", F.to_json(F.array(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("n")))).alias("js"))


@query("js_02_nested_access", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("js_03_flatten", "SELECT n_nationkey, i::INT AS i, 'E' || i AS e FROM nation, range(0, 3) x(i)")
def _(t):
    nested = t.nation.select("n_nationkey", F.array(*[F.struct(F.lit(f"E{i}").alias("e")) for i in range(3)]).alias("ev"))
    return nested.select("n_nationkey", F.posexplode("ev").alias("i", "x")).select("n_nationkey", "i", F.col("x.e").alias("e"))


@query("js_04_scalar_or_blank", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id::VARCHAR ELSE '' END AS v FROM events")
def _(t):
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"a":'), F.col("event_id").cast("string"), F.lit("}"))).otherwise('{"a":[]}')
    v = F.get_json_object(raw, "$.a")
    return t.events.select("event_id", F.when(v.isNull() | v.rlike(r"^[\[{]"), "").otherwise(v).alias("v"))


# coordinates: two components of each vector, scaled into the region
def points(t):
    e = t.embeddings
    return e.select("vec_id", (F.lit(108.25) + F.col("embedding")[0].cast("double") * 4).alias("lon"), (F.lit(23.7) + F.col("embedding")[1].cast("double") * 3).alias("lat"))


PTS = "p AS (SELECT vec_id, 108.25::DOUBLE + embedding[1]::DOUBLE * 4 AS lon, 23.7::DOUBLE + embedding[2]::DOUBLE * 3 AS lat FROM embeddings)"
ALB = f"""{PTS}, s AS (SELECT *, sin(radians(lat)) AS s FROM p), q AS (SELECT *, {1 - G._E2!r} * (s / (1 - {G._E2!r} * s * s) - ln((1 - {G._E!r} * s) / (1 + {G._E!r} * s)) / (2 * {G._E!r})) AS q FROM s),
r AS (SELECT *, {G.A!r} * sqrt({G._C!r}::DOUBLE - {G._N!r}::DOUBLE * q) / {G._N!r}::DOUBLE AS rho, {G._N!r}::DOUBLE * radians(lon - {G.LON0!r}) AS th FROM q), xy AS (SELECT vec_id, rho * sin(th) AS x, {G._RHO0!r}::DOUBLE - rho * cos(th) AS y FROM r)"""


@query("ge_09_albers", f"WITH {ALB} SELECT vec_id, round(x, 3) AS x, round(y, 3) AS y FROM xy")
def _(t):
    x, y = G.albers(F.col("lon"), F.col("lat"))
    return points(t).select("vec_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("ge_03_albers_round_trip", "SELECT count(*) AS n, true AS exact FROM embeddings")
def _(t):
    x, y = G.albers(F.col("lon"), F.col("lat"))
    p = points(t).withColumns({"x": x, "y": y})
    lon, lat = G.albers_inverse(F.col("x"), F.col("y"))
    return p.agg(F.count("*").alias("n"), F.bool_and((F.abs(lon - F.col("lon")) < 1e-8) & (F.abs(lat - F.col("lat")) < 1e-8)).alias("exact"))


GRID = "CASE WHEN {i} < 0 THEN 'N' ELSE '' END || lpad(abs({i})::VARCHAR, 6, '0')"


@query("ge_20_grid_id", f"WITH {ALB}, g AS (SELECT vec_id, floor((y + 300000) / 1000)::BIGINT AS r, floor((x + 400000) / 1000)::BIGINT AS c FROM xy) SELECT vec_id, 'GX1K_R' || {GRID.format(i='r')} || '_C' || {GRID.format(i='c')} AS grid_id FROM g")
def _(t):
    x, y = G.albers(F.col("lon"), F.col("lat"))
    return points(t).select("vec_id", G.grid_id(x, y).alias("grid_id"))


@query("prj_10_grid_id_format", f"SELECT s_suppkey, 'GX1K_R' || {GRID.format(i='(s_suppkey - 20)')} || '_C' || {GRID.format(i='(30 - s_suppkey)')} AS id FROM supplier")
def _(t):
    k = F.col("s_suppkey")
    return t.supplier.select("s_suppkey", G.grid_id((30 - k) * 1000.0 + 500, (k - 20) * 1000.0 + 500, 0.0, 0.0).alias("id"))


GCJ = f"""{PTS}, d AS (SELECT *, lon - 105.0 AS x, lat - 35.0 AS y FROM p), w AS (SELECT *, (20.0 * sin(6.0 * x * pi()) + 20.0 * sin(2.0 * x * pi())) * 2.0 / 3.0 AS w, 1 - {G.KRASOVSKY_EE!r} * sin(radians(lat)) * sin(radians(lat)) AS m FROM d),
o AS (SELECT *, (-100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * sqrt(abs(x)) + w + (20.0 * sin(y * pi()) + 40.0 * sin(y / 3.0 * pi())) * 2.0 / 3.0 + (160.0 * sin(y / 12.0 * pi()) + 320.0 * sin(y * pi() / 30.0)) * 2.0 / 3.0)
 * 180.0 / ({G.KRASOVSKY_A!r} * (1 - {G.KRASOVSKY_EE!r}) / (m * sqrt(m)) * pi()) AS dlat,
 (300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * sqrt(abs(x)) + w + (20.0 * sin(x * pi()) + 40.0 * sin(x / 3.0 * pi())) * 2.0 / 3.0 + (150.0 * sin(x / 12.0 * pi()) + 300.0 * sin(x / 30.0 * pi())) * 2.0 / 3.0)
 * 180.0 / ({G.KRASOVSKY_A!r} / sqrt(m) * cos(radians(lat)) * pi()) AS dlon FROM w)"""


@query("ge_06_datum_forward", f"WITH {GCJ} SELECT vec_id, round(lon + dlon, 8) AS lon, round(lat + dlat, 8) AS lat FROM o")
def _(t):
    lon, lat = G.shifted(F.col("lon"), F.col("lat"))
    return points(t).select("vec_id", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


@query("ge_07_datum_inverse", f"WITH {PTS} SELECT vec_id, round(lon, 8) AS lon, round(lat, 8) AS lat FROM p")
def _(t):
    lon, lat = G.shifted(F.col("lon"), F.col("lat"))
    back = points(t).withColumns({"glon": lon, "glat": lat}).withColumn("u", G.unshifted(F.col("glon"), F.col("glat")))
    return back.select("vec_id", F.round("u.lon", 8).alias("lon"), F.round("u.lat", 8).alias("lat"))


@query("ge_08_shift_bands", f"WITH {GCJ}, s AS (SELECT vec_id, sqrt(pow(dlon * 111320 * cos(radians(lat)), 2) + pow(dlat * 110540, 2)) AS m FROM o) SELECT vec_id, CASE WHEN m < 10 OR m > 5000 THEN 'extreme' WHEN m < 50 OR m > 2000 THEN 'attention' ELSE 'normal' END AS band FROM s")
def _(t):
    lon, lat = G.shifted(F.col("lon"), F.col("lat"))
    m = F.hypot((lon - F.col("lon")) * 111320 * F.cos(F.radians("lat")), (lat - F.col("lat")) * 110540)
    return points(t).select("vec_id", P.ladder(((m < 10) | (m > 5000), "extreme"), ((m < 50) | (m > 2000), "attention"), otherwise="normal").alias("band"))


@query("ge_01_grid_cells", "SELECT r::INT AS row, c::INT AS col, 'GX1K_R' || lpad(r::VARCHAR, 6, '0') || '_C' || lpad(c::VARCHAR, 6, '0') AS grid_id FROM range(0, 40) a(r), range(0, 60) b(c)")
def _(t):
    rows = t.spark.range(40).select(F.col("id").cast("int").alias("row"))
    cells = rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(59))))
    return cells.withColumn("grid_id", G.grid_id(F.col("col") * 1000.0 + 1, F.col("row") * 1000.0 + 1, 0.0, 0.0))


TRI = "LINESTRING(0 0, 50 0, 25 40, 0 0)"


# by hand: the four rows of cells that the triangle meets hold 5, 5, 3 and 3 of them; base 50 by height 40
@query("ge_02_cell_clip", "SELECT 50.0 * 40.0 / 2::DOUBLE AS total, (5 + 5 + 3 + 3)::BIGINT AS cells")
def _(t):
    ring = G.line_points(F.lit(TRI))
    cells = t.spark.range(5).withColumn("c", F.col("id") * 10.0).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("y", F.col("r") * 10.0)
    area = G.clipped_area(F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"]), F.col("c"), F.col("y"), F.col("c") + 10, F.col("y") + 10)
    kept = cells.withColumn("a", area).where("a > 1e-6")
    return kept.agg(F.round(F.sum("a"), 6).alias("total"), F.count("*").alias("cells"))


@query("ge_13_points_in_polygon", "SELECT i, j FROM range(0, 23) a(i), range(0, 23) b(j) WHERE j * 40.0 / 23 + 0.5 < 40 AND (j * 40.0 / 23 + 0.5) * 25 / 40 < i * 50.0 / 23 + 0.7 AND i * 50.0 / 23 + 0.7 < 50 - (j * 40.0 / 23 + 0.5) * 25 / 40")
def _(t):
    p = t.spark.range(23).select(F.col("id").alias("i")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(22).cast("long"))))
    return p.where(G.point_in_ring(F.col("i") * 50.0 / 23 + 0.7, F.col("j") * 40.0 / 23 + 0.5, G.line_points(F.lit(TRI)))).select("i", "j")


@query("ge_17_footprint_overlap", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, (greatest(least(a.n_nationkey, b.n_nationkey) + 5.0 - greatest(a.n_nationkey, b.n_nationkey), 0) * 2)::DOUBLE AS area FROM nation a, nation b WHERE a.n_nationkey < b.n_nationkey AND b.n_nationkey < a.n_nationkey + 5")
def _(t):
    box = lambda k: (k.cast("double"), 0.0, k + 5.0, 2.0)
    n = t.nation.select(F.col("n_nationkey").alias("a"))
    m = n.withColumn("b", F.explode(F.sequence(F.col("a") + 1, F.col("a") + 4))).join(J.sized(n.select(F.col("a").alias("b"))), "b", "left_semi")
    return m.withColumn("area", G.box_overlap(box(F.col("a")), box(F.col("b")))).where("area > 0").select("a", "b", "area")


@query("ge_22_line_length", "SELECT s_suppkey, 5.0 * s_suppkey AS length FROM supplier")
def _(t):
    k = F.col("s_suppkey").cast("string")
    wkt = F.concat(F.lit("LINESTRING ("), F.lit("0 0, "), (F.col("s_suppkey") * 3).cast("string"), F.lit(" "), (F.col("s_suppkey") * 4).cast("string"), F.lit(")"))
    return t.supplier.select("s_suppkey", G.line_length(G.line_points(wkt)).alias("length"))


@query("jn_08_point_in_cell", f"WITH {ALB}, g AS (SELECT floor(x / 100000)::BIGINT AS cx, floor(y / 100000)::BIGINT AS cy FROM xy) SELECT cx, cy, count(*) AS n FROM g GROUP BY ALL")
def _(t):
    x, y = G.albers(F.col("lon"), F.col("lat"))
    return points(t).groupBy(F.floor(x / 100000).alias("cx"), F.floor(y / 100000).alias("cy")).agg(F.count("*").alias("n"))


XY = "a AS (SELECT c_custkey, c_acctbal AS ax, (c_custkey % 997)::DOUBLE AS ay FROM customer), b AS (SELECT s_suppkey, s_acctbal AS bx, (s_suppkey * 37 % 997)::DOUBLE AS bz FROM supplier)"


@query("jn_13_distance_join", f"WITH {XY} SELECT c_custkey, s_suppkey, sqrt((ax - bx) * (ax - bx) + (ay - bz) * (ay - bz)) AS dist FROM a, b WHERE sqrt((ax - bx) * (ax - bx) + (ay - bz) * (ay - bz)) <= 100")
def _(t):
    a = t.customer.select("c_custkey", F.col("c_acctbal").alias("ax"), (F.col("c_custkey") % 997).cast("double").alias("ay"))
    b = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("bx"), (F.col("s_suppkey") * 37 % 997).cast("double").alias("by"))
    return J.cell_pairs(a, b, 100.0).select("c_custkey", "s_suppkey", "dist")


@query("jn_14_nearest", f"WITH {XY}, d AS (SELECT c_custkey, s_suppkey, sqrt((ax - bx) * (ax - bx) + (ay - bz) * (ay - bz)) AS dist FROM a, b), r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY dist, s_suppkey) AS r FROM d) SELECT c_custkey, s_suppkey, dist FROM r WHERE r = 1")
def _(t):
    a = t.customer.select("c_custkey", F.col("c_acctbal").alias("ax"), (F.col("c_custkey") % 997).cast("double").alias("ay"))
    b = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("bx"), (F.col("s_suppkey") * 37 % 997).cast("double").alias("by"))
    return J.nearest(a, b, "c_custkey", "s_suppkey")


@query("jn_15_distance_band", f"WITH {XY}, d AS (SELECT c_custkey, min(sqrt((ax - bx) * (ax - bx) + (ay - bz) * (ay - bz))) AS dist FROM a, b GROUP BY 1) SELECT c_custkey, CASE WHEN dist <= 20 THEN 'inside' WHEN dist <= 100 THEN 'near' END AS exposure FROM d WHERE dist <= 100")
def _(t):
    a = t.customer.select("c_custkey", F.col("c_acctbal").alias("ax"), (F.col("c_custkey") % 997).cast("double").alias("ay"))
    b = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("bx"), (F.col("s_suppkey") * 37 % 997).cast("double").alias("by"))
    d = J.cell_pairs(a, b, 100.0).groupBy("c_custkey").agg(F.min("dist").alias("dist"))
    return d.select("c_custkey", F.when(F.col("dist") <= 20, "inside").otherwise("near").alias("exposure"))
