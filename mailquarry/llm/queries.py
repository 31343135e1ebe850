"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailquarry.llm import binary, embeddings, fill_middle, jaccard, lines, mixing, packing, pii, quality, repeats, resampling, toxicity
from mailquarry.llm._runtime import stage_path

#: Where the vocabulary files lie.
TOKENIZERS = os.environ.get("MAILQUARRY_TOKENIZERS", "")


def tokenizer(name: str) -> str:
    """The path of a vocabulary file, under MAILQUARRY_TOKENIZERS or else in the installed package."""
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(mixing.mix(documents(spark, sf_dir))).drop("row_id")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.dedup(documents(spark, sf_dir), long_tokens=lines.LONG_TOKENS)
    return left.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op5_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(vectors(spark, sf_dir))


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.top_products(vectors(spark, sf_dir))


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token_ids")
    binary.write_ids(documents(spark, sf_dir), path, tokenizer("byte_bpe_50k.json"))
    return binary.index(spark, path)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", "held_out", "score", "predicted", "n_sentences", F.array_join(spans, ",").alias("offending"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_line_templates": op3_line_templates,
    "op4_quality": op4_quality,
    "op5_embedding_duplicates": op5_embedding_duplicates,
    "op7_repeated_bytes": op7_repeated_bytes,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_top_products": op9_top_products,
    "op6_token_binary": op6_token_binary,
    "op10_personal_data": op10_personal_data,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": mixing.SQL,
    "op3_line_templates": lines.SQL,
    "op9_top_products": embeddings.TOP_SQL,
    "op12_importance_resampling": resampling.SQL,
    "op13_fill_in_middle": fill_middle.SQL,
}
