"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import langid, pii, quality
from terraloom.llm.common import id_mod
from terraloom.llm.decontam import contaminated
from terraloom.llm.embeddings import near_duplicates
from terraloom.llm.jaccard import jaccard_components
from terraloom.llm.katz import katz_scores
from terraloom.llm.line_dedup import dedup_pages, dedup_shared
from terraloom.llm.mixing import mix_sources
from terraloom.llm.secrets import secret_digests


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), id_mod("doc_id", 5) == 1)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_mod("doc_id", 5) == 0
    net = quality.fit(docs.where(~held), table(spark, sf_dir, "labels"))
    out = quality.with_quality(docs, net)
    return out.select("doc_id", held.alias("held_out"), F.col("_quality").alias("score"), (F.col("_quality") >= 0.3).cast("int").alias("predicted"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = id_mod("doc_id", 3) == 1
    model = langid.fit(docs.where(~held))
    out = langid.with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), F.col("_lang.lang").alias("lang_pred"), F.col("_lang.score").alias("score"), F.col("_lang.rate").alias("rate"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op9_line_dedup_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_shared(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


OP9 = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(regexp_split_to_array(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|\n'), lambda x: trim(x) <> '') AS ls
  FROM pages),
l AS (SELECT host, unnest(list_distinct(ls)) AS line FROM p),
c AS (SELECT host, line, count(*) AS n FROM l GROUP BY ALL),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY ALL),
b AS (SELECT c.host, list(line) AS boiler FROM c JOIN t ON c.host IS NOT DISTINCT FROM t.host
      WHERE pages >= 5 AND n > 0.3 * pages AND n >= 2 GROUP BY ALL),
k AS (SELECT page_id, p.host, ls, CASE WHEN boiler IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(boiler, x)) END AS kept
      FROM p LEFT JOIN b ON p.host IS NOT DISTINCT FROM b.host)
SELECT page_id, host, coalesce(len(ls), 0)::BIGINT AS n_lines, (coalesce(len(ls), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped,
       CASE WHEN ls IS NOT NULL THEN md5(coalesce(array_to_string(kept, chr(10)), '')) END AS text_md5
FROM k"""

OP9_SHARED = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(regexp_split_to_array(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|\n'), lambda x: trim(x) <> '') AS ls
  FROM pages),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(ls)) AS line FROM p) GROUP BY ALL),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY ALL),
g AS (SELECT line, sum(n)::DOUBLE / (SELECT count(*) + 50.0::DOUBLE FROM p) AS g FROM c GROUP BY line),
b AS (SELECT c.host, list(c.line) AS boiler FROM c JOIN t ON c.host IS NOT DISTINCT FROM t.host JOIN g ON c.line = g.line
      WHERE n + 50.0::DOUBLE * g > (CASE WHEN length(c.line) < 20 THEN 0.3 ELSE 0.07 END)::DOUBLE * (pages + 50.0::DOUBLE) GROUP BY c.host),
k AS (SELECT page_id, p.host, ls, CASE WHEN boiler IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(boiler, x)) END AS kept
      FROM p LEFT JOIN b ON p.host IS NOT DISTINCT FROM b.host)
SELECT page_id, host, coalesce(len(ls), 0)::BIGINT AS n_lines, (coalesce(len(ls), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped,
       CASE WHEN ls IS NOT NULL THEN md5(coalesce(array_to_string(kept, chr(10)), '')) END AS text_md5
FROM k"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT *, (('0x' || substr(h, 1, 4))::BIGINT % 256) AS chunk FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most FROM s),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
z AS (SELECT arg_min(level, most / weight) AS water FROM v WHERE level * weight <= most),
t AS (SELECT source, source_size, CASE WHEN water IS NULL THEN most ELSE least(most, water * weight) END::DOUBLE AS target FROM v, z),
q AS (SELECT sum(target) AS total FROM t),
g AS (SELECT total, least(4096, greatest(1, floor(total / 40000)))::BIGINT AS block FROM q),
cum AS (SELECT source, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / total AS hi, ceil(source_size / block::DOUBLE)::BIGINT AS blocks, target FROM t, g),
slots AS (SELECT i, i * 0.6180339887498949::DOUBLE - floor(i * 0.6180339887498949::DOUBLE) AS x FROM (SELECT unnest(range(1, (SELECT round(total / block)::BIGINT FROM g) + 1)) AS i)),
bnd AS (SELECT list(struct_pack(hi := hi, source := source, blocks := blocks) ORDER BY hi) AS bounds FROM cum WHERE target > 0),
pick AS (SELECT i, coalesce(list_filter(bounds, lambda b: b.hi > x)[1], bounds[-1]) AS hit FROM slots, bnd),
ranked AS (SELECT hit.source AS source, hit.blocks AS blocks, row_number() OVER (PARTITION BY hit.source ORDER BY i) - 1 AS r FROM pick),
used AS (SELECT source, r % blocks AS b, count(*) AS times FROM ranked WHERE r < 2 * blocks GROUP BY ALL),
laid AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY chunk, h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM e),
pieces AS (SELECT doc_id, source, e, size, unnest(range((e - size) // block, (e - 1) // block + 1)) AS b, block FROM laid, g WHERE size > 0),
took AS (SELECT doc_id, sum((least(e, (pieces.b + 1) * block) - greatest(e - size, pieces.b * block)) * times)::BIGINT AS taken
         FROM pieces JOIN used ON pieces.source IS NOT DISTINCT FROM used.source AND pieces.b = used.b GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN took USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op8_source_mix": OP8, "op9_line_dedup": OP9, "op9_line_dedup_shared": OP9_SHARED}
