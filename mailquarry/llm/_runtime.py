"""Shared folder, staged tables and other session plumbing of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder of its own.
    """
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError(f"{SETTING} must name a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="mailquarry-")
    spark.conf.set(SETTING, own)
    return own


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for a staged table in the shared folder."""
    return f"{shared_dir(spark)}/mailquarry-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: what follows neither recomputes ``df`` nor depends on the executors that
    made it, so losing one costs at most the tasks that were running.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    return [next(n for k in range(len(taken) + 1) if (n := "_" * k + name) not in taken) for name in names]


def release(spark: SparkSession) -> None:
    """Delete all tables that this session has staged; results that still read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/mailquarry-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
