"""Folders for intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which driver and executors share; a local session without it gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = "file://" + tempfile.mkdtemp(prefix="mailquarry-")
    return f"{shared.rstrip('/')}/mailquarry-{name}-{uuid.uuid4().hex}"
