"""The whole feature pipeline: raw mails to parsed mails, URLs, header and body features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.functions.body import body_features, with_body_features
from mailquarry.functions.headers import header_features
from mailquarry.functions.urls import extract_urls, url_wordlist
from mailquarry.sources.eml import ingest
from mailquarry.sources.files import write_wordlist


def wide_features(mails: DataFrame) -> DataFrame:
    """All header and body features and the number of URLs, a row per mail. Both sides come from the same row, so nothing is joined or shuffled."""
    urls = F.size(extract_urls(F.col("_body"))).cast("long").alias("url_count")
    texts = with_body_features(mails.select("email_id", "raw_headers", F.col("body").alias("_body")), "_body").select("*", urls).drop("_body")
    names = [c for c in texts.columns if c not in ("email_id", "raw_headers")]
    packed = texts.select(F.struct("email_id", *names).alias("email_id"), "raw_headers")
    heads = header_features(packed, one_pass=True)
    return heads.select("email_id.*", *[c for c in heads.columns if c != "email_id"])


def run_pipeline(spark: SparkSession, source: str | list[str], target: str, label: str | None = None, glob: str | None = None, mode: str = "errorifexists") -> dict[str, str]:
    """Parse once to Parquet, then write body features, header features and the URL list from it; returns their paths.

    Later steps read only the columns that they need, so attachments are written once and not read again.
    """
    paths = {n: f"{target}/{n}" for n in ("parsed", "body_features", "header_features", "urls")}
    ingest(spark, source, glob, label).write.mode(mode).parquet(paths["parsed"])
    mails = spark.read.parquet(paths["parsed"])
    body_features(mails).write.mode(mode).parquet(paths["body_features"])
    header_features(mails).write.mode(mode).parquet(paths["header_features"])
    write_wordlist(url_wordlist(mails), paths["urls"], mode)
    return paths


def joined_features(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The written header and body features of each mail side by side."""
    return spark.read.parquet(paths["header_features"]).join(spark.read.parquet(paths["body_features"]), "email_id")
