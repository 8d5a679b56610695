"""Impact, priority, sensitivity, trend and supply operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.operators.ranking import global_rank
from terraloom.operators.windows import min_max
from terraloom.sources.shared import with_checkpoints

#: Model weights of the priority indicators (fixed values; they sum to one).
WEIGHTS = {"population": 0.30, "facility": 0.15, "flood_area": 0.20, "road": 0.15, "settlements": 0.05, "rescue_distance": 0.15}


def priority(df: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Min-max normalised indicators, weighted contributions, their total and its rank (ties share a rank).

    One row per district reaches the ranking window."""
    out = min_max(df, list(weights))
    for c, w in weights.items():
        out = out.withColumn(f"{c}_part", F.col(f"{c}_norm") * w)
    out = out.withColumn("score", sum((F.col(f"{c}_part") for c in weights), F.lit(0.0)))
    return out.withColumn("rank", F.rank().over(Window.orderBy(F.desc(F.round("score", 12)))))


def sensitivity(df: DataFrame, key: str, weights: dict[str, float] = WEIGHTS, change: float = 0.2) -> DataFrame:
    """(key, rank_min, rank_max, stable) over scenarios in which one weight at a time moves by ``change``, not renormalised."""
    scenarios = [{k: w * (1 + (s if k == c else 0)) for k, w in weights.items()} for c in weights for s in (-change, change)]
    norm = min_max(df, list(weights))
    scores = F.array(*[F.struct(F.lit(i).alias("scenario"), sum((F.col(f"{c}_norm") * w for c, w in s.items()), F.lit(0.0)).alias("score")) for i, s in enumerate(scenarios)])
    flat = norm.select(key, F.inline(scores))
    ranked = global_rank(flat.withColumn("_s", F.round("score", 12)), "r", "scenario", "_s")
    return ranked.groupBy(key).agg(F.min("r").alias("rank_min"), F.max("r").alias("rank_max")).withColumn("stable", F.col("rank_min") == F.col("rank_max"))


def exposure(distance: Column, near: float = 500.0) -> Column:
    return F.when(distance == 0, "inside_flood").when(distance <= near, "near_flood")


def facility_weight(kind: Column) -> Column:
    """Impact weight of a facility kind (fixed values)."""
    return F.when(kind.isin("hospital", "elderly_home"), 3).when(kind == "school", 2)


def trend(rising: Column, falling: Column, stations: Column, red: Column) -> Column:
    """A red warning and a majority rising: may expand; all falling: receding; else unclear."""
    return F.when(red & (rising * 2 > stations), "continued_expansion_possible").when(falling == stations, "receding_by_followup_date").otherwise("undetermined")


def demand(people: Column, days: int = 3, litres: int = 3) -> tuple[Column, Column]:
    """(meals as person-days, water in litres)."""
    return F.ceil(people) * days, F.ceil(people) * litres


def first_success(attempts: DataFrame, case: str, distance: str, ok: Column) -> DataFrame:
    """Per case the nearest source that works and how many were tried; ``no_safe_route`` if none does."""
    w = Window.partitionBy(case).orderBy(distance)
    r = attempts.withColumn("_r", F.row_number().over(w)).withColumn("_ok", ok)
    return r.groupBy(case).agg(F.min(F.when(F.col("_ok"), F.col("_r"))).alias("_hit"), F.count("*").alias("_all"), F.min(F.when(F.col("_ok"), F.col(distance))).alias(distance)).select(
        case, distance, F.coalesce("_hit", "_all").alias("attempts"), F.when(F.col("_hit").isNull(), "no_safe_route").otherwise("assigned").alias("status"))


def shortest_paths(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(case, node, dist): shortest distances from each case's origin over undirected ``edges`` (u, v, w).

    Frontier relaxation with joins; only nodes whose distance fell go on. Each round is checkpointed, so the
    plan stays short and lost executors cost one round. Weights must not be negative (this raises): then it ends,
    after as many rounds as the longest shortest path has edges."""
    spark = edges.sparkSession
    edges = edges.withColumn("w", F.when(F.assert_true(F.col("w") >= 0, F.lit("negative weight")).isNull(), F.col("w")))
    two = edges.select("u", "v", "w").union(edges.select("v", "u", "w")).groupBy("u", "v").agg(F.min("w").alias("w"))
    with_checkpoints(spark)
    two = two.checkpoint()
    best = sources.select("case", "node", F.lit(0.0).alias("dist")).checkpoint()
    front = best
    while True:
        step = front.join(two, front["node"] == two["u"]).groupBy("case", F.col("v").alias("node")).agg(F.min(F.col("dist") + F.col("w")).alias("cand"))
        nxt = step.join(best, ["case", "node"], "left").where(F.col("dist").isNull() | (F.col("cand") < F.col("dist"))).select("case", "node", F.col("cand").alias("dist")).checkpoint()
        if nxt.limit(1).count() == 0:
            break
        best = best.unionByName(nxt).groupBy("case", "node").agg(F.min("dist").alias("dist")).checkpoint()
        front = nxt
    return best
