"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in local mode, where the driver is also the executor, may go
    without: it gets a fresh temporary folder.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tidemark-")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared root, used by one run only."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
