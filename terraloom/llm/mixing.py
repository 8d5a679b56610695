"""Mixing sources to target weights with a low-discrepancy schedule.

Slot ``i`` of the mix falls on the golden-ratio point ``frac(i * 0.618...)``; the cumulative target shares of
the sources map that point to a source; the slots of a source are ranked; slot rank ``r`` takes block
``r mod blocks`` of that source's shuffled documents, cut into blocks of equally many words. Ranks and
running sums are two-level (chunk totals, then inside a chunk), so a source with a third of all rows is never
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import staged

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
#: Slots in a mix: blocks hold total/SLOTS words, at least one and at most MAX_BLOCK.
SLOTS, MAX_BLOCK = 40_000, 4096
SLOT_CHUNK = 4096
#: Hash chunks in which a source's shuffled documents are summed up.
CHUNKS = 256
#: Cells in which points meet the sources' shares; rows (sources, or cells of sources) up to which a table is broadcast.
GRID, BROADCAST_ROWS = 4096, 100_000


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) for a table (source, size).

    Sources sort by code point, null last, and weigh ``weights`` in turn. ``share`` of all words is dealt by
    weight; a source takes at most ``cap`` times its size and the excess is dealt again by weight: the
    water level is the first at which every fuller source is capped. One row per source passes the windows in
    one task: up to some ten million sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("most", F.lit(cap) * F.col("source_size"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy(F.lit(0))
    per = per.withColumn("level", (F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(all_rows)["level"]
    return per.withColumn("water", level).select(
        "source", "source_size", "weight",
        F.when(F.col("water").isNull(), F.col("most")).otherwise(F.least("most", F.col("water") * F.col("weight"))).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words the mix takes from each document.

    A null or empty text has size 0 and gives nothing; repeated rows each count; an empty table gives no
    rows; a null source is a source of its own. Extra columns are ignored. Equal ids shuffle to adjacent
    places; reruns give the same rows.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    d = d.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    d = staged(d.withColumn("chunk", F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % CHUNKS), "sizes")
    t = staged(source_targets(d, weights, share, cap), "targets")

    total = t.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = int(min(MAX_BLOCK, max(1, total // slots)))
    n_slots = int(round(total / block))

    # the schedule: slots on golden-ratio points, ranked inside their source
    running = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    cum = t.withColumn("hi", F.sum("target").over(running) / F.lit(total or 1.0)).withColumn(
        "blocks", F.ceil(F.col("source_size") / block))
    # a point lies in one cell of a grid over [0, 1), a source in those its interval of shares touches: an equi-join
    upto = Window.orderBy("hi", F.col("source").asc_nulls_last())
    shares = (cum.where("target > 0").select("source", "hi", "blocks").withColumn("lo", F.coalesce(F.lag("hi").over(upto), F.lit(0.0)))
              .withColumn("hi", F.when(F.lead("hi").over(upto).isNull(), F.lit(2.0)).otherwise(F.col("hi"))))
    cell = lambda x: F.least(F.floor(x * GRID), F.lit(GRID - 1)).cast("int")
    shares = staged(shares.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi"))))), "shares")
    i = F.col("id").cast("double")
    x = i * GOLDEN - F.floor(i * GOLDEN)
    spark = docs.sparkSession
    ring = spark.range(1, n_slots + 1, 1, max(1, n_slots // 500_000)).withColumn("x", x).withColumn("cell", cell(F.col("x")))
    ring = ring.join(F.broadcast(shares) if shares.count() <= BROADCAST_ROWS else shares, "cell").where((F.col("lo") <= F.col("x")) & (F.col("x") < F.col("hi")))
    ring = staged(ring.select("id", "source", "blocks", F.floor(F.col("id") / SLOT_CHUNK).alias("chunk")), "slots")
    per_chunk = ring.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    per_chunk = per_chunk.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n")).drop("n")
    in_chunk = Window.partitionBy("source", "chunk").orderBy("id")
    ranked = (ring.withColumn("r", F.row_number().over(in_chunk) - 1)
              .join(per_chunk.withColumnRenamed("source", "s2").withColumnRenamed("chunk", "c2"),
                    F.col("source").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
              .withColumn("rank", F.col("r") + F.col("before")))
    used = (ranked.where(F.col("rank") < F.floor(F.lit(cap)) * F.col("blocks"))
            .groupBy(F.col("source").alias("s3"), (F.col("rank") % F.col("blocks")).alias("b")).agg(F.count("*").alias("times")))

    # shuffled documents of a source laid end to end; a document covers a range of blocks
    sums = d.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n")).drop("n")
    place = Window.partitionBy("source", "chunk").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = (d.withColumn("end", F.sum("size").over(place))
            .join(sums.withColumnRenamed("source", "s2").withColumnRenamed("chunk", "c2"),
                  F.col("source").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
            .withColumn("end", F.col("end") + F.col("base")).withColumn("start", F.col("end") - F.col("size"))
            .select("doc_id", "source", "size", "start", "end", F.monotonically_increasing_id().alias("row")))
    laid = staged(laid, "laid")
    pieces = (laid.where("size > 0")
              .withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
              .withColumn("words", F.least("end", (F.col("b") + 1) * block) - F.greatest("start", F.col("b") * block)))
    took = (pieces.join(used.withColumnRenamed("b", "b3"), F.col("source").eqNullSafe(F.col("s3")) & (F.col("b") == F.col("b3")))
            .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    return (laid.join(took, "row", "left")
            .join(F.broadcast(t.select(F.col("source").alias("s4"), "source_size", "target")) if t.count() <= BROADCAST_ROWS
                  else t.select(F.col("source").alias("s4"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s4")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
