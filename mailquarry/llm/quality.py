"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
#: At most so many labelled documents train the model, those of the smallest hashes of their ids.
MAX_TRAINING_ROWS = 8_000
EPOCHS = 4
THRESHOLD = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE = 150_000
_known: dict[str, int] = {}
_hashes = np.zeros(1 << 16, np.uint64)
_shapes = np.zeros(1 << 16, np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(64 - BITS)


def _shape(token: str) -> str:
    """A word's form: case, digits, marks by themselves."""
    if not token[0].isalnum():
        return token[:4]
    if token.isalpha():
        return "A" if token.isupper() and len(token) > 1 else "Aa" if token[0].isupper() else "a"
    return "0" if token.isdigit() else "a0"


def _tokens(text: str) -> np.ndarray:
    """Numbers of a text's tokens in the worker's table of hashes and shapes."""
    global _hashes, _shapes
    words = _TOKEN.findall(text)
    if len(_known) > _CACHE:
        _known.clear()
    for w in set(words).difference(_known):
        n = len(_known)
        if n == len(_hashes):
            _hashes, _shapes = np.resize(_hashes, 2 * n), np.resize(_shapes, 2 * n)
        _hashes[n], _shapes[n], _known[w] = zlib.crc32(w.lower().encode()), zlib.crc32(b"shape " + _shape(w).encode()), n
    return np.fromiter(map(_known.__getitem__, words), np.int64, len(words))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vector of a text: buckets of its word 1- and 2-grams and of its word forms' 1- to 3-grams, and values of length 1.

    In the forms a word that repeats the one before it has a form of its own. Null or empty: no entries.
    """
    at = _tokens(text or "")
    if not len(at):
        return np.zeros(0, np.int32), np.zeros(0)
    words, forms = _hashes[at], _shapes[at].copy()
    forms[1:][at[1:] == at[:-1]] = 7
    grams = [words * _ODD, (words[:-1] * np.uint64(31) + words[1:]) * _ODD]
    code = forms
    for n in (1, 2, 3):
        grams.append((code + np.uint64(n)) * _ODD)
        code = code[:-1] * np.uint64(1_000_003) + forms[n:]
    buckets, counts = np.unique((np.concatenate(grams) >> _FOLD).astype(np.int32), return_counts=True)
    values = np.sqrt(counts)
    return buckets, values / np.linalg.norm(values)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of a logistic regression; the last is the bias. Rows are taken in the given order."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for buckets, values, label in rows:
            i, x = np.append(buckets, 1 << BITS), np.append(values, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weights(slice(None))


def held_out(id_col: Column) -> Column:
    """Whether labels of this document may not be learned: its id's crc32 is divisible by 5."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 0


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([x[0].astype("<i4").tobytes() for x in found], pa.binary()), pa.array([x[1].astype("<f4").tobytes() for x in found], pa.binary())],
            ["h", "label", "buckets", "amounts"],
        )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [x for b in batches for x in b.to_pylist()]
    rows.sort(key=lambda x: (x["h"], x["label"], x["buckets"], x["amounts"]))
    rows = [(np.frombuffer(x["buckets"], "<i4"), np.frombuffer(x["amounts"], "<f4").astype(float), x["label"]) for x in rows]
    yield pa.RecordBatch.from_arrays([pa.array([ftrl(rows).astype("<f4").tobytes()], pa.binary())], ["weights"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Weights learned from at most ``max_rows`` labelled documents that are not held out.

    Documents that have both labels are left out; of rows of one id the least text is learned. The sample's ids are bounded by max_rows, so they are
    broadcast; its vectors are made where the documents lie, and one task runs the updates over them.
    """
    usable = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).where("label = most")
    sample = usable.select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "h", "label").agg(F.min("text").alias("text"))
    vectors = rows.select("h", "text", "label").mapInArrow(_vectors, "h long, label int, buckets binary, amounts binary")
    return np.frombuffer(vectors.repartition(1).mapInArrow(_trained, "weights binary").head()[0], "<f4")


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns score (probability of label 1) and predicted (1 if score >= threshold).

    A column that has one of these names is replaced. The weights, of fixed size, go with the tasks. Null or empty texts get the bias's score.
    """
    w = weights.astype(np.float64)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        sums = np.array([w[b] @ v for b, v in map(features, texts)], dtype=float)
        return pd.Series(1 / (1 + np.exp(-(sums + w[-1]))))

    out = docs.withColumn("score", scored(F.col(text_col)))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted.

    The text alone decides the score: ids, labels, languages and sources are no inputs. An empty
    document table gives no rows; without usable labels every score is 0.5.
    """
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), train(docs, labels, id_col, text_col))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
