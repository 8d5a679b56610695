"""Line dedup by site-relative frequency.

A line's ratio is the number of a host's pages that contain it over the host's pages; lines whose ratio
exceeds ``max_ratio`` on a host with at least ``min_pages`` pages are boilerplate and go. With a ``prior`` the
host's ratio is pooled with the line's ratio over all hosts, and the rule needs no least number of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import staged

#: Boilerplate entries up to which the per-host lists are broadcast; beyond it they are joined by salted host.
BROADCAST_LINES = 50_000
SALTS = 32
#: Ratio between those of shared and of ordinary lines; pages of the pooled ratio in every host's own; characters
#: below which a text block of HTML is often a single word, and the ratio over which it goes.
SHARED, PRIOR, SHORT, SHORT_RATIO = 0.07, 50, 20, 0.3
#: Tags, comments, scripts and styles part the lines of an HTML page.
HTML_BREAK = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|\n"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def shared_lines(counts: DataFrame, totals: DataFrame, max_ratio: float | Column, prior: float) -> DataFrame:
    """(_host, line) of ``counts`` (_host, line, n) whose pooled ratio (n + prior * g) / (pages + prior) exceeds
    ``max_ratio`` (an expression over ``line``), g being the line's pages over ``prior`` + pages of all hosts.

    Few pages of a host, or of the whole table, thus weigh little against chance, and a line shared by all
    hosts goes on the small ones too. Totals by hash only choose candidates (never too few: hashes that
    coincide add up, and over the ratio n or prior * g is half of it at least); those are then summed by line.
    """
    totals = staged(totals.withColumnRenamed("_host", "h2"), "sites")
    everything = float(totals.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]) + prior
    ratio = max_ratio if isinstance(max_ratio, Column) else F.lit(max_ratio)
    c = counts.join(totals, F.col("_host").eqNullSafe(F.col("h2"))).withColumn("key", F.xxhash64("line")).withColumn("half", ratio / 2)
    keys = (c.groupBy("key").agg(F.sum("n").alias("total"), F.max(F.col("n") / (F.col("pages") + prior)).alias("peak"), F.min("half").alias("half"))
            .where((F.col("peak") >= F.col("half")) | (F.col("total") >= F.col("half") * everything)).select("key"))
    c = staged(c.join(keys, "key").select("_host", "line", "n", "pages"), "candidates")
    g = c.groupBy("line").agg((F.sum("n") / everything).alias("g"))
    return c.join(g, "line").where(F.col("n") + prior * F.col("g") > ratio * (F.col("pages") + prior)).select("_host", "line")


def drop_site_lines(pages: DataFrame, host: Column, lines: Column, max_ratio: float | Column, min_pages: int = 1, prior: float = 0) -> DataFrame:
    """``pages`` with two more columns: ``_lines`` (array of kept lines, in order) and ``_n`` (lines before).

    ``host`` and ``lines`` are expressions over ``pages``; ``lines`` gives an array of strings. Blank lines
    are neither counted nor dropped. A null host is a host of its own; null lines stay null (``_n`` is 0).
    Repeated pages each count. An empty table gives no rows. A line kept on one host may go on another.
    Per host at most (mean lines a page) / ``max_ratio`` lines can exceed the ratio, so each host's list is
    small; the lists are broadcast only if their counted total is at most BROADCAST_LINES. With ``prior``, see
    ``shared_lines``; ``min_pages`` is not used then.
    """
    p = pages.withColumn("_host", host).withColumn("_all", lines)
    one = F.array_distinct(F.filter("_all", lambda x: F.trim(x) != ""))
    totals = p.groupBy("_host").agg(F.count("*").alias("pages"))
    # map-side counts first: a line on every page of the largest host is one row a task
    counts = (p.select("_host", F.explode(one).alias("line")).groupBy("_host", "line").agg(F.count("*").alias("n")))
    if prior:
        over = shared_lines(counts, totals, max_ratio, prior)
    else:
        counts = counts.where(F.col("n") >= max(2.0, max_ratio * min_pages))
        totals = totals.where(F.col("pages") >= min_pages).withColumnRenamed("_host", "h2")
        over = counts.join(totals, F.col("_host").eqNullSafe(F.col("h2"))).where(F.col("n") > max_ratio * F.col("pages"))
    boiler = (over
              .groupBy(F.col("_host").alias("h3")).agg(F.sort_array(F.collect_list("line")).alias("_boiler")))
    boiler = staged(boiler, "boiler")
    n = boiler.agg(F.coalesce(F.sum(F.size("_boiler")), F.lit(0))).first()[0]
    if n <= BROADCAST_LINES:
        j = p.join(F.broadcast(boiler), F.col("_host").eqNullSafe(F.col("h3")), "left")
    else:
        p = p.withColumn("_salt", (F.rand(7) * SALTS).cast("int"))
        salted = boiler.withColumn("s3", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        j = p.join(salted, F.col("_host").eqNullSafe(F.col("h3")) & (F.col("_salt") == F.col("s3")), "left").drop("_salt", "s3")
    kept = F.when(F.col("_boiler").isNull(), F.col("_all")).otherwise(
        F.filter("_all", lambda x: ~F.array_contains("_boiler", x)))
    return (j.withColumn("_lines", kept).withColumn("_n", F.coalesce(F.size("_all"), F.lit(0)))
            .withColumn("_n", F.greatest("_n", F.lit(0))).drop("_host", "_all", "h3", "_boiler"))


def dedup_pages(pages: DataFrame, max_ratio: float | Column = 0.3, min_pages: int = 5, prior: float = 0) -> DataFrame:
    """(page_id, host, n_lines, n_dropped, text) of raw web pages: the text blocks of the HTML without the
    host's boilerplate. A null URL has a null host; null HTML has no lines and a null text."""
    p = pages.select("page_id", F.lower(F.regexp_extract("url", HOST, 1)).alias("host"), "html")
    lines = F.filter(F.split("html", HTML_BREAK), lambda x: F.trim(x) != "")
    out = drop_site_lines(p, F.col("host"), lines, max_ratio, min_pages, prior)
    return out.select("page_id", "host", F.col("_n").cast("long").alias("n_lines"),
                      (F.col("_n") - F.greatest(F.coalesce(F.size("_lines"), F.lit(0)), F.lit(0))).cast("long").alias("n_dropped"),
                      F.array_join("_lines", "\n").alias("text"))


def dedup_shared(pages: DataFrame) -> DataFrame:
    """``dedup_pages`` by the pooled ratio; blocks under SHORT characters, mostly single words, need SHORT_RATIO."""
    return dedup_pages(pages, F.when(F.length("line") < SHORT, SHORT_RATIO).otherwise(SHARED), prior=PRIOR)
