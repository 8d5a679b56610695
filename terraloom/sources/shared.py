"""The folder that all executors share: spark.checkpoint.dir; a temporary one only under a local master."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables. On a cluster without spark.checkpoint.dir this raises: its executors share no
    local disk."""
    global _local
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local is None:
        _local = tempfile.mkdtemp(prefix="terraloom-")
    return _local


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no one has used."""
    return f"{shared_folder(spark)}/terraloom/{uuid.uuid4().hex}/{name}"


def with_checkpoints(spark: SparkSession) -> None:
    """Makes ``checkpoint()`` usable where spark.checkpoint.dir is unset under a local master."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
