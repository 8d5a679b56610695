"""Text functions: cleaning, names and addresses, stable ids, classification ladders, snippets and parsers.

All are Column expressions; only the Ratcliff-Obershelp ratio and exact NFKC have no built-in equivalent and
are vectorised Python functions.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.functions.ratio import ratios
from terraloom.operators.projection import ladder

#: Full-width ASCII and the ideographic space, with what NFKC makes of them.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


def narrow(x: Column) -> Column:
    """Full-width ASCII to ASCII: the part of NFKC that plain translation can do."""
    return F.translate(x, WIDE, NARROW)


@F.pandas_udf(T.StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Exact NFKC."""
    return x.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def clean_cell(x: Column) -> Column:
    """Narrowed, without zero-width marks and without any white space; null is empty."""
    return F.regexp_replace(narrow(F.coalesce(x, F.lit(""))), "[​﻿\\s]+", "")


def clean_text(x: Column) -> Column:
    """Narrowed, line ends unified, runs of blanks one space, at most one blank line, trimmed."""
    y = F.regexp_replace(narrow(F.coalesce(x, F.lit(""))), "[​﻿]", "")
    y = F.regexp_replace(F.regexp_replace(y, "\r\n?", "\n"), "[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(y, "\n{3,}", "\n\n"), "^\\s+|\\s+$", "")


def normalize_name(x: Column) -> Column:
    return F.translate(clean_cell(x), "【】（）", "[]()")


def explicit_aliases(x: Column) -> Column:
    """Names listed in a bracket that says so: ``X(former name: Y; Z)``."""
    inside = F.regexp_extract(x, r"\((?:formerly|alias|aka)\s*:\s*([^)]*)\)", 1)
    return F.filter(F.transform(F.split(inside, "[;,]"), lambda v: F.trim(v)), lambda v: v != "")


def credit_code(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(x, F.lit(""))), "[^0-9A-Z]", "")


def groupable_code(x: Column) -> Column:
    """The looser of two code checks: any 18 letters and digits."""
    return x.rlike("^[0-9A-Z]{18}$")


def valid_code(x: Column) -> Column:
    """The stricter check: the letters I, O, S, V and Z do not occur."""
    return x.rlike("^[0-9A-HJ-NPQRTUWXY]{18}$")


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 16 hex digits of the SHA-1 of the parts joined by U+001F; null parts are empty."""
    joined = F.concat_ws(chr(31), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(joined), 1, 16))


def six_digit_code(x: Column) -> Column:
    """Trailing six digits of a numeric id, tolerant of a float's ``.0``; null otherwise."""
    y = F.regexp_replace(x, r"\.0$", "")
    return F.when(y.rlike("[0-9]{6}$"), F.right(y, F.lit(6)))


def contains_any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def matched_keywords(x: Column, words: list[str], sep: str = "|") -> Column:
    """The words that occur, in the dictionary's order."""
    return F.array_join(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(x, w)), sep)


def occurrences(x: Column, token: str) -> Column:
    return ((F.length(x) - F.length(F.replace(x, F.lit(token), F.lit("")))) / len(token)).cast("long")


def snippet(x: Column, token: str, limit: int = 180) -> Column:
    """``limit`` characters around the first hit, a third of them before it; empty without a hit."""
    at = F.instr(x, token)
    return F.when(at > 0, F.substr(x, F.greatest(at - limit // 3, F.lit(1)), F.lit(limit))).otherwise("")


def anchored(x: Column, anchor: Column) -> Column:
    """Whether the anchor occurs once white space and width no longer matter."""
    return F.contains(clean_cell(x), clean_cell(anchor))


def truthy(x: Column) -> Column:
    return F.lower(F.trim(x)).isin("1", "true", "yes", "y")


def location_text(x: Column) -> Column:
    """``lon,lat`` as six-decimal text, null if it is not two numbers in range."""
    p = F.split(x, ",")
    lon, lat = F.try_element_at(p, F.lit(1)).try_cast("double"), F.try_element_at(p, F.lit(2)).try_cast("double")
    ok = (F.size(p) == 2) & lon.between(-180, 180) & lat.between(-90, 90)
    return F.when(ok, F.format_string("%.6f,%.6f", lon, lat))


def rgba(x: Column) -> Column:
    """#rrggbb or #rrggbbaa as an array of four numbers; opaque by default."""
    part = lambda i: F.conv(F.substring(x, i, 2), 16, 10).cast("int")
    return F.array(part(2), part(4), part(6), F.when(F.length(x) >= 9, part(8)).otherwise(255))


def chainage_m(x: Column) -> Column:
    """K316+900 as metres."""
    return F.regexp_extract(x, r"K([0-9]+)\+([0-9]+)", 1).try_cast("long") * 1000 + F.regexp_extract(x, r"K([0-9]+)\+([0-9]+)", 2).try_cast("long")


def tile_corner(x: Column) -> tuple[Column, Column]:
    """(lat, lon) of a tile name such as N22E108 or S05W060."""
    sign = lambda i, neg: F.when(F.regexp_extract(x, "([NS])([0-9]{2})([EW])([0-9]{3})", i) == neg, -1).otherwise(1)
    num = lambda i: F.regexp_extract(x, "([NS])([0-9]{2})([EW])([0-9]{3})", i).try_cast("int")
    return sign(1, "S") * num(2), sign(3, "W") * num(4)


def key_values(x: Column) -> Column:
    """``Key: value`` lines as a map; the last of repeated keys counts."""
    pairs = F.filter(F.transform(F.split(x, "\n"), lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)).alias("k"), F.trim(F.regexp_replace(s, "^[^:]*:", "")).alias("v"))), lambda p: p["k"] != "")
    return F.map_from_entries(pairs)


def checksum_line(x: Column) -> tuple[Column, Column]:
    """(hash, path) of a checksum list's line; a binary-mode star goes."""
    return F.lower(F.regexp_extract(x, r"^([0-9A-Fa-f]+)\s+\*?(.*)$", 1)), F.regexp_extract(x, r"^([0-9A-Fa-f]+)\s+\*?(.*)$", 2)


def entity_type(name: Column, category: Column) -> Column:
    """Kind of entity by name and source: market, base, outlet, physical site, organization, unknown; first match."""
    # fixed values: the words that decide
    return ladder((category.eqNullSafe("wholesale_market") | name.rlike("批发市场|交易市场"), "market"), (name.rlike("稳产保供基地|基地$"), "base"),
                  (name.rlike("供应网点|门店|超市|便利店"), "outlet"), (name.rlike("粮食储备库|储备粮库|粮库|储备库|直属库|中心库|库区"), "physical_site"),
                  (name.rlike("公司|集团|合作社|商行|经营部|厂$|中心$|研究院|邮政"), "organization"), otherwise="unknown")


def analysis_priority(province: Column, city: Column) -> Column:
    return ladder((city == "南宁市", "primary"), (city == "柳州市", "secondary"), (province == "广西壮族自治区", "reserve"), otherwise="external")


def evidence_level(category: Column, address: Column, text: Column) -> Column:
    """A to D by source category, then by facility words."""
    # fixed values: the words that decide
    return ladder((category.isin("wholesale_market", "grain_reserve", "cold_chain", "basket_supply_base"), "A"),
                  (category.isin("grain_emergency", "grain_storage") & text.rlike("粮库|储备库|配送中心|应急保障中心"), "A"), (category.isin("grain_emergency", "grain_storage"), "B"),
                  ((category == "government_procurement") & address.rlike("仓库|粮库|储备库|配送中心|冷库|厂房|加工厂|物流中心"), "B"), (category == "government_procurement", "C"), otherwise="D")


def node_type(name: Column, text: Column, category: Column) -> Column:
    """struct(node_type, recognition, note) of a supply record by source category, then by the first matching words."""
    def kind(value: str, recognition: str, note: str = "") -> Column:
        return F.struct(F.lit(value).alias("node_type"), F.lit(recognition).alias("recognition"), F.lit(note).alias("note"))

    whole = F.concat(normalize_name(name), clean_cell(text))
    bare, among = normalize_name(name), category.isin("grain_emergency", "grain_storage")
    # fixed values: recognitions, notes and the words that decide
    listed, national = "广西储备商品管理公司及其直属库名单（桂财税〔2024〕8号）", "国家级粮食应急保障企业"
    reserve = category == "grain_reserve"
    return ladder((category == "wholesale_market", kind("agricultural_wholesale_market", "农业农村部定点市场")),
                  (category == "cold_chain", kind("cold_chain_distribution_center", "县级农产品冷链集配中心")),
                  (category == "basket_supply_base", kind("basket_supply_base", "菜篮子稳产保供基地")),
                  (category == "government_procurement", kind("government_procurement_supplier", "政府采购入围/中标供应商", "采购供应商身份不等同于实体仓储节点。")),
                  (reserve & bare.rlike("军粮供应|军粮配送|军供站|军粮仓储|粮油军供"), kind("military_grain_supply", listed)),
                  (reserve & bare.rlike("粮食储备库|储备粮库|粮库|储备库|直属库|中心库|库区"), kind("grain_depot", listed)),
                  (reserve & bare.rlike("储备粮管理|粮食收储|粮油收储|粮食购销|粮油购销|粮食管理所|粮所|粮食储备中心|粮食和物资储备|粮食购储|储备管理"), kind("grain_reserve", listed, "名单证明储备体系资格，但企业主体或管理机构名称不等同于具体物理粮库。")),
                  (reserve, kind("other", listed, "属于储备商品管理公司及其直属库名单，但名称不足以安全判断为具体粮库或储备管理机构。")),
                  (among & whole.rlike("军粮"), kind("military_grain_supply", national)),
                  (among & whole.rlike("粮食储备库|储备粮库|粮库|储备库|直属库|中心库"), kind("grain_depot", national)),
                  (among & whole.rlike("储备粮管理|粮食收储|粮油购销"), kind("grain_reserve", national)),
                  (among & whole.rlike("配送中心|配送"), kind("emergency_distribution_center", national)),
                  (among & whole.rlike("物流|粮运|储运"), kind("emergency_storage_transport", national)),
                  (among & whole.rlike("面粉|米业|油脂|食品|粮油|加工"), kind("emergency_processing", national)),
                  (among, kind("other", national, "官方名单未给出储运、加工、配送等具体子类，保守归为 other。")),
                  otherwise=kind("other", "", "来源信息不足，保守归为 other。"))


def product_flags(text: Column, category: Column | None = None, market: Column | None = None) -> dict[str, Column]:
    """Product kinds that a text names. Grain sources always supply grain; a wholesale market (its own text in
    ``market``) always fresh food, and what its name says."""
    # fixed values: the words of each kind
    words = {"grain": "粮食|大米|米面|面粉|粮油|米粉|面食", "oil": "食用油|油脂|粮油|米面油", "processed_food": "副食品|调味|早餐|米粉|面包|糕点|豆制品|干货|奶制品|饮品|冷冻品|食品", "meat": "畜肉|禽肉|鲜肉|肉类|肉及",
             "vegetable": "蔬菜|时蔬|果蔬", "fruit": "水果|果蔬", "aquatic_product": "水产|海鲜", "dairy": "奶制品|乳制品|牛奶", "daily_goods": "日用品|日用百货|生活用品"}
    # fixed values: the words in a market's name
    names = {"grain": "粮油", "oil": "粮油", "aquatic_product": "水产|海鲜", "fruit": "果|水果", "vegetable": "菜|蔬菜", "meat": "肉|畜禽|牛羊"}
    flags = {k: text.rlike(w) for k, w in words.items()}
    none = F.lit(False)
    of = F.coalesce(category, F.lit("")) if category is not None else F.lit("")
    flags["grain"] = flags["grain"] | of.isin("grain_emergency", "grain_reserve", "grain_storage")
    fresh = none
    for k in ("meat", "vegetable", "fruit", "aquatic_product", "dairy"):
        fresh = fresh | flags[k]
    is_market = of == "wholesale_market"
    for k, w in names.items():
        flags[k] = flags[k] | (is_market & (normalize_name(market if market is not None else text)).rlike(w))
    return flags | {"fresh_food": is_market | fresh}


def capability_flags(text: Column, site: Column, category: Column | None = None, reserve_text: Column | None = None) -> dict[str, Column]:
    """Facility capabilities; a line of frozen goods alone proves no cold store at the site, and a wholesale market
    always distributes. Records of grain reserves are judged by ``reserve_text`` (name and address) alone."""
    of = F.coalesce(category, F.lit("")) if category is not None else F.lit("")
    if reserve_text is not None:
        text = F.when(of == "grain_reserve", reserve_text).otherwise(text)
    # fixed values: the words of each capability
    words = {"storage": "仓库|粮库|储备库|冷库|库房|仓储|直属库|中心库|库区", "processing": "加工厂|加工中心|生产车间|厂房|食品厂|米粉厂|面粉|油脂加工", "distribution": "配送中心|配送有限公司|食品配送|餐饮配送|物流中心|物流集团|粮运物流",
             "retail": "供应网点|门店|超市|便利店|零售", "cold_chain": "冷链中心|冷链物流|冷库"}
    out = {f"{k}_capability": text.rlike(w) for k, w in words.items()}
    out["distribution_capability"] = out["distribution_capability"] | (of == "wholesale_market")
    out["cold_chain_capability"] = out["cold_chain_capability"] & ~(F.contains(text, F.lit("冷冻品类")) & ~site.rlike("冷链|冷库"))
    return out


def region_of(x: Column, regions: list[tuple[str, str, str]]) -> Column:
    """First (province, city, county) whose county, else city, else province name occurs in the text."""
    hit = None
    for level in (2, 1, 0):
        for row in regions:
            v = F.struct(*[F.lit(row[i] if i <= level else "").alias(n) for i, n in enumerate(("province", "city", "county"))])
            cond = F.contains(x, F.lit(row[level])) if row[level] else F.lit(False)
            hit = F.when(cond, v) if hit is None else hit.when(cond, v)
    return hit


def detailed_address(x: Column, city: Column, county: Column) -> Column:
    """Whether an address says more than its region: six characters and a street or place word."""
    y = normalize_name(x)
    for token in (F.lit("广西壮族自治区"), F.lit("广西"), city, county):
        y = F.when(F.coalesce(token, F.lit("")) != "", F.replace(y, token, F.lit(""))).otherwise(y)
    return (F.length(y) >= 6) & y.rlike("路|街|道|巷|号|村|镇|乡|园|区|大厦|楼|屯|坡")


def address_parts(x: Column) -> Column:
    """struct(town, street, number)."""
    return F.struct(F.regexp_extract(x, "([^\\s,]+(?:town|镇|乡|街道))", 1).alias("town"), F.regexp_extract(x, "([^\\s,]+(?:street|road|路|街|道))", 1).alias("street"), F.regexp_extract(x, "([0-9]+(?:-[0-9]+)?)(?:号|$)", 1).alias("number"))


def search_names(x: Column) -> Column:
    """Distinct spellings to search by: whole, without the legal form, without the region as well."""
    bare = F.regexp_replace(x, "(有限责任公司|股份有限公司|集团有限公司|有限公司)$", "")
    return F.array_distinct(F.filter(F.array(x, bare, F.regexp_replace(bare, "^(广西壮族自治区|广西|南宁市|柳州市)", "")), lambda v: v != ""))


def match_name(x: Column) -> Column:
    return F.regexp_replace(F.lower(narrow(F.coalesce(x, F.lit("")))), "[\\s·•,，.。()（）\\[\\]【】\\-_—/\\\\]", "")


@F.arrow_udf(T.DoubleType())
def sequence_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Ratcliff-Obershelp ratio of two names; null counts as empty."""
    x, y = (v.fill_null("").dictionary_encode() for v in (a, b))
    return pa.array(ratios(x.dictionary.to_pylist(), y.dictionary.to_pylist(), x.indices.to_numpy(), y.indices.to_numpy()))


def name_similarity(a: Column, b: Column) -> Column:
    """``match_similarity`` of the match names."""
    return match_similarity(match_name(a), match_name(b))


def match_similarity(x: Column, y: Column) -> Column:
    """Ratio of match names; of contained names at least shorter over longer; 0 if one is empty."""
    ratio = sequence_ratio(x, y)
    inside = F.contains(x, y) | F.contains(y, x)
    share = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y))
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(inside, F.greatest(ratio, share)).otherwise(ratio)


def semantic_name(x: Column) -> Column:
    """The match name without the region it starts with and without legal forms, so that relatives stay apart."""
    # fixed values: regions and legal forms
    wide, narrow_ = "广西壮族自治区|广西|南宁市|柳州市", "兴宁区|青秀区|江南区|西乡塘区|良庆区|邕宁区|武鸣区|横州市|宾阳县|上林县|马山县|隆安县|城中区|鱼峰区|柳南区|柳北区|柳江区|柳城县|鹿寨县|融安县|融水苗族自治县|三江侗族自治县"
    y = F.regexp_replace(F.regexp_replace(match_name(x), f"^(?:{wide})", ""), f"^(?:{narrow_})", "")
    return F.regexp_replace(y, "(?:有限责任公司|股份有限公司|集团有限公司|有限公司)", "")


def safe_name_match(a: Column, b: Column, least: float = 0.9) -> Column:
    """Whether two names mean the same entity: equal semantic names, or a ratio of at least ``least``; never if one is empty."""
    x, y = semantic_name(a), semantic_name(b)
    return (x != "") & (y != "") & ((x == y) | (sequence_ratio(x, y) >= least))
