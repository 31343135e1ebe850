"""Attachments of parsed mails: a manifest, and the files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailquarry.functions.attachments import decode
from mailquarry.sources.mailfiles import write_files

PREFIX = "test_attachments"


def manifest(mails: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(email_id, key, n_bytes, hash, n_same): a row per attachment, its target key, and how many of its mail share that key."""
    each = mails.select("email_id", F.explode("attachments").alias("a"))
    rows = each.select("email_id", F.concat_ws("/", F.lit(prefix), "email_id", F.col("a.filename")).alias("key"), F.length(decode(F.col("a.data_base64"))).cast("long").alias("n_bytes"), F.col("a.hash").alias("hash"))
    return rows.withColumn("n_same", F.count("*").over(Window.partitionBy("email_id", "key")).cast("long"))


def rebuild(mails: DataFrame, target: str | None = None, staging: str | None = None, prefix: str = PREFIX) -> DataFrame:
    """Write every attachment to the file of its key under ``target``, on the executors; without a target, a dry run. Returns the manifest.

    ``target`` is a path of any file system that pyarrow reaches, ``staging`` a folder for the tables of the commit. Files appear whole or not at
    all, see ``mailfiles.write_files``. Of attachments of one mail that share a key the last is written. Parts of a key that stand
    for folders become underscores there.
    """
    if target is not None:
        if staging is None:
            raise ValueError("a folder for the commit's tables is needed")
        files = mails.select("email_id", F.posexplode("attachments").alias("pos", "a"))
        files = files.select(F.concat_ws("/", F.lit(prefix), "email_id", F.col("a.filename")).alias("key"), decode(F.col("a.data_base64")).alias("content"), F.lpad(F.col("pos").cast("string"), 10, "0").alias("place"))
        write_files(files, target, staging, order="place")
    return manifest(mails, prefix)
