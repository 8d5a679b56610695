"""Entity resolution: explicit links, identity keys, merge policies, scored matches and guarded updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.text import groupable_code
from terraloom.sources.shared import with_checkpoints


def linked_groups(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): smallest node reachable over explicit links, by minimum labels and pointer jumps."""
    spark = edges.sparkSession
    with_checkpoints(spark)
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = e.union(e.select("y", "x")).distinct().toDF("node", "other").checkpoint()
    root = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")).checkpoint()
    while True:
        near = both.join(root.toDF("other", "root"), "other").select("node", "root").unionByName(root).groupBy("node").agg(F.min("root").alias("root"))
        jump = near.select(F.col("node").alias("root"), F.col("root").alias("up"))
        nxt = near.join(jump, "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root")).checkpoint()
        if nxt.join(root.withColumnRenamed("root", "was"), "node").where("root <> was").limit(1).count() == 0:
            return nxt
        root = nxt


def unique_codes(df: DataFrame, name: str, kind: str, code: str) -> DataFrame:
    """(name, kind, linked_code) where all valid codes of a name and kind are one."""
    g = df.where(groupable_code(F.col(code))).groupBy(name, kind).agg(F.min(code).alias("linked_code"), F.max(code).alias("_hi"))
    return g.where(F.col("linked_code") == F.col("_hi")).drop("_hi")


def identity_key(code: Column, linked: Column, name: Column, kind: Column, record: Column) -> Column:
    """A valid code, else the one code of the name, else the name, each with the entity kind; else the record."""
    return F.coalesce(F.when(groupable_code(code), F.concat_ws(":", F.lit("credit"), code, kind)), F.when(linked.isNotNull(), F.concat_ws(":", F.lit("credit"), linked, kind)),
                      F.when(name != "", F.concat_ws(":", F.lit("name"), name, kind)), F.concat(F.lit("record:"), record.cast("string")))


def accepted(score: Column, runner_up: Column, least: float, margin: float) -> Column:
    """accepted, ambiguous (the runner-up is closer than ``margin``) or rejected."""
    return F.when(score < least, "rejected").when(score - runner_up < margin, "ambiguous").otherwise("accepted")


def upserted(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``old`` with the given columns taken from ``new`` where it has the key, plus new keys; other
    columns of new keys are null. Only ``columns`` can change."""
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_new"))
    j = old.withColumn("_old", F.lit(True)).join(n, key, "full")
    return j.select(*[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


def unchanged(before: DataFrame, after: DataFrame, key: str, targets: DataFrame) -> DataFrame:
    """Rows outside of ``targets`` that differ: an empty result is the guard's pass."""
    keep = lambda d: d.join(targets.select(key), key, "left_anti").select(before.columns)
    return keep(before).exceptAll(keep(after))


def geocode_scores(df: DataFrame, similarity: Column, city_ok: Column, county_ok: Column) -> DataFrame:
    """``df`` with score and similarity (four digits): the address ratio, with a bonus or a penalty for city and county."""
    raw = similarity + F.when(city_ok, 0.20).otherwise(-0.50) + F.when(county_ok, 0.10).otherwise(-0.15)
    return df.withColumns({"similarity": F.round(similarity, 4), "score": F.round(raw, 4), "city_ok": city_ok, "county_ok": county_ok})


def chosen_geocode(scored: DataFrame, key: str, target_detailed: str) -> DataFrame:
    """(key, location, reject, confidence): the best answer in the right region, or why there is none.

    No answer, the wrong city, two answers within 0.08 of each other, or a coarse level for an address that says less
    than a street are rejected, in this order. ``target_detailed`` is a column of the target, equal in its rows."""
    # fixed values: levels too coarse for a point
    coarse = ("省", "市", "区县", "乡镇", "村庄")
    able = (F.col("location") != "") & F.col("city_ok") & F.col("county_ok")
    order = F.struct(-F.col("score"), -F.col("similarity"), F.col("name"), F.col("location"), F.col("level"))
    best = F.slice(F.array_sort(F.collect_list(F.when(able, order))), 1, 2)
    # two answers are enough: the lists are bounded by the answers a request may have
    g = scored.groupBy(key).agg(best.alias("b"), F.max(F.when(~F.col("city_ok"), True)).alias("elsewhere"), F.bool_or(F.col(target_detailed)).alias("detailed"))
    top, nxt = F.try_element_at("b", F.lit(1)), F.try_element_at("b", F.lit(2))
    reject = (F.when(F.size("b") == 0, F.when(F.col("elsewhere"), "region_mismatch").otherwise("no_result"))
              .when(nxt["col1"] - top["col1"] < 0.08, "multiple_matches").when(top["level"].isin(*coarse) & ~F.col("detailed"), "name_mismatch").otherwise(""))
    g = g.withColumn("reject", reject)
    fine = F.col("reject") == ""
    return g.select(key, F.when(fine, top["location"]).alias("location"), "reject", F.when(fine, F.when(-top["col2"] >= 0.75, "high").otherwise("medium")).otherwise("").alias("confidence"))
