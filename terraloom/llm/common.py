"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir. Where that is unset, a local master (as in tests)
    gets a temporary folder; a cluster gets an error, as its executors share no local disk."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="terraloom-")
    return _local_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it again: the lineage is cut and lost
    executors cost no recomputation beyond their running tasks."""
    path = f"{scratch_root(df.sparkSession)}/terraloom/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._terraloom_path = path
    return out


def drop_staged(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_terraloom_path", None)
        if path:
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Has Spark clean the shuffle files of finished steps: Python drops its handles, then the JVM its
    references, then Spark's cleaner thread follows; the second round sees what the first let go."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.6)


def in_batches_of(limit: int, rows: int) -> Callable:
    """Decorates an operator on a DataFrame so that, while it runs, Arrow batches close at ``limit`` bytes (a row longer than
    that still travels whole) and Parquet is decoded ``rows`` rows at a time. For operators whose Python steps all end before
    they return, as the old settings come back then.

    By default a batch holds 10,000 rows or 64 MB and 4,096 rows are decoded at once. The JVM's buffers and the Python worker
    hold several times a batch, and texts decoded at once are one array, for which the heap must grow."""
    small = {"spark.sql.execution.arrow.maxBytesPerBatch": limit, "spark.sql.parquet.columnarReaderBatchSize": rows}

    def wrap(f: Callable) -> Callable:
        @functools.wraps(f)
        def run(docs: DataFrame, *args, **kwargs):
            conf = docs.sparkSession.conf
            was = {key: conf.get(key, None) for key in small}
            try:
                for key, value in small.items():
                    conf.set(key, value)
                return f(docs, *args, **kwargs)
            finally:
                for key, value in was.items():
                    conf.unset(key) if value is None else conf.set(key, value)

        return run

    return wrap


def id_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the empty string)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(modulus)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node for each node of undirected ``edges``: columns (node, component).

    Minimum labels travel along the edges, then pointers jump (label of label), so chains and stars of any
    length settle in a logarithmic number of rounds. Each round is a hash aggregation with map-side minima
    and its table is written to the shared folder; nothing but one count per round reaches the driver.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = staged(e.union(e.select("b", "a")).distinct().toDF("src", "dst"), "edges")
    labels = staged(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("component"))
                    .select(F.col("src").alias("node"), "component"), "labels")
    while True:
        seen = both.join(labels.toDF("dst", "component"), "dst")
        best = (seen.select(F.col("src").alias("node"), "component").unionByName(labels)
                .groupBy("node").agg(F.min("component").alias("component")))
        parent = best.select(F.col("node").alias("component"), F.col("component").alias("up"))
        nxt = best.join(parent, "component", "left").select(
            "node", F.least(F.col("component"), F.coalesce("up", "component")).alias("component"))
        nxt = staged(nxt, "labels")
        changed = nxt.join(labels.withColumnRenamed("component", "was"), "node").where("component <> was").limit(1).count()
        drop_staged(labels)
        labels = nxt
        if not changed:
            drop_staged(both)
            return labels
