"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark decontamination, source mix.

Every stage gets all that its predecessor kept, written as Parquet and read again; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm import langid
from terraloom.llm.common import staged
from terraloom.llm.decontam import with_contamination
from terraloom.llm.jaccard import jaccard_components
from terraloom.llm.line_dedup import PRIOR, SHARED, drop_site_lines
from terraloom.llm.mixing import mix_sources

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from the corpus's own labels; texts without a
    letter (null and empty ones too) go, and texts of whose n-grams no learned language holds about half (the
    fewer n-grams, the fewer will do). Without any label there is no learned language, and nothing stays."""
    d = docs.select(*COLUMNS)
    return langid.with_language(d, langid.fit(d)).where(langid.in_learned(F.col("_lang"))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that over 7 % of their source's documents hold, by the ratio pooled with that of
    all sources; ``n_chars`` follows. A document of which nothing is left goes; null texts stay as they are."""
    out = drop_site_lines(docs.select(*COLUMNS), F.col("source"), F.split("text", "\n"), max_ratio=SHARED, prior=PRIOR)
    dropped = F.size("_lines") < F.col("_n")
    text = F.when(dropped, F.array_join("_lines", "\n")).otherwise(F.col("text"))
    out = out.withColumn("_text", text).where(F.col("text").isNull() | ~dropped | (F.trim("_text") != ""))
    return out.select("doc_id", F.col("_text").alias("text"), "lang", "source", F.when(dropped, F.length("_text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id, of repeated rows one. Documents
    without words are in no group and all stay."""
    d = docs.select(*COLUMNS)
    kept = jaccard_components(d).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.max("n_shingles").alias("_n"))
    kept = kept.withColumnRenamed("doc_id", "_id")
    one = Window.partitionBy("doc_id").orderBy(F.length("text").desc(), F.xxhash64("text", "source", "lang"))
    out = d.join(kept, F.col("doc_id").eqNullSafe(F.col("_id"))).withColumn("_row", F.row_number().over(one))
    return out.where((F.col("_n") == 0) | (F.col("_row") == 1)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs within the error budget."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_contamination(docs.select(*COLUMNS), items).where("_hits = 0").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document."""
    return mix_sources(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("decontamination", decontamination), ("source_mix", source_mix)]

#: The language filters and the edit distances cannot be told in SQL; test_pipeline_stages holds each stage against
#: brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
