"""The shared folder for what a run writes beside its tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where it is unset, a local session gets a folder of its own; a
    cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tableguard-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
