"""The corpus pipeline: stages that each take (spark, docs, sf_dir) and return the next stage's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.llm import jaccard, lines, mixing, packing, quality
from mailquarry.llm._runtime import stage
from mailquarry.llm.queries import documents, tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the others go."""
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights).where(F.col("predicted") == 1).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates and long lines that others have; one of which nothing is left goes, as every line of it stands elsewhere."""
    left = lines.dedup(docs, long_tokens=lines.LONG_TOKENS).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, and of rows of that id one; null ids are last. Rows are told by id and text."""
    kept = jaccard.kept_rows(jaccard.near_duplicates(docs, with_groups=True)).withColumnsRenamed({"doc_id": "kept_id", "twin": "kept_twin"})
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_twin"))
    return docs.join(kept, same).dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, mixing.mix(docs)).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as token sequences: a row per piece."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the classifier, the tokens and the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on what the one before it has written."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
