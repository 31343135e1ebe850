"""Logistic regression over n-gram counts: split, pipeline, metrics, persistence."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.functions.ngrams import char_ngrams, vectorizer, vocabulary
from mailquarry.functions.text import ratio

VOCABULARY = 10_000
#: Test rows have a hash below this, of 256: a fifth.
TEST_BELOW = "33"


def is_test(key: Column) -> Column:
    """Whether a row belongs to the test part; decided by its key alone, so it stays however rows are dealt."""
    return F.substring(F.md5(key.cast("string")), 1, 2) < TEST_BELOW


def with_grams(df: DataFrame, text: str = "url", grams: str = "grams") -> DataFrame:
    return df.withColumn(grams, char_ngrams(F.col(text)))


def train(rows: DataFrame, label: str = "label", grams: str = "grams", size: int = VOCABULARY, strength: float = 1.0, rounds: int = 100, vocabulary_of: DataFrame | None = None, l1_ratio: float = 0.0, weight: str | None = None, tolerance: float = 1e-6) -> PipelineModel:
    """Count vectors and a penalised logistic regression of them; ``strength`` is the inverse of the penalty on the summed loss.

    The vocabulary comes from ``vocabulary_of``, by default from the training rows.
    """
    counts = vectorizer(rows.sparkSession, vocabulary(vocabulary_of if vocabulary_of is not None else rows, grams, size), grams, "features")
    n = max(1, rows.count())
    model = LogisticRegression(featuresCol="features", labelCol=label, maxIter=rounds, regParam=1 / (strength * n), elasticNetParam=l1_ratio, standardization=False, tol=tolerance)
    if weight:
        model = model.setWeightCol(weight)
    return PipelineModel([counts, model.fit(counts.transform(rows.withColumn(label, F.col(label).cast("double"))))])


def gradient(model: PipelineModel, rows: DataFrame, key: str, label: str = "label", grams: str = "grams") -> DataFrame:
    """(term, gradient): the slope of the penalised mean loss along every weight of a fitted model, 0 all over at its optimum; the intercept's term is null.

    Recomputed from the rows, apart from the solver: a row's residual goes with each of its grams, and is summed by term before the
    shuffle, so that nothing but the vocabulary's terms is joined. Weights, at most as many as the vocabulary, come from the model. For models
    without L1 part; ``rows`` are those it was trained on, with ``key`` as their id.
    """
    counts, fitted = model.stages[0], model.stages[1]
    penalty = fitted.getOrDefault("regParam")
    spark = rows.sparkSession
    weights = spark.createDataFrame([(t, float(w)) for t, w in zip(counts.vocabulary, fitted.coefficients.toArray(), strict=True)], "term string, weight double")
    residual = model.transform(rows).select(key, grams, (vector_to_array("probability")[1] - F.col(label)).alias("residual"))
    n = rows.count()
    each = residual.select("residual", F.explode(grams).alias("term")).join(F.broadcast(weights.select("term")), "term")
    slopes = each.groupBy("term").agg(F.sum("residual").alias("slope"))
    of_terms = weights.join(slopes, "term", "left").select("term", (F.coalesce("slope", F.lit(0.0)) / n + penalty * F.col("weight")).alias("gradient"))
    return of_terms.unionByName(residual.agg(F.avg("residual").alias("gradient")).select(F.lit(None).cast("string").alias("term"), "gradient"))


def metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(n, accuracy, precision, recall, f1) of class 1 to four digits, 0 where a denominator is; one aggregate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    sums = scored.agg(F.count("*").alias("n"), count(y == p).alias("right"), count(y & p).alias("tp"), count(p).alias("said"), count(y).alias("real"))
    return sums.select("n", ratio(F.col("right"), F.col("n"), 4).alias("accuracy"), ratio(F.col("tp"), F.col("said"), 4).alias("precision"), ratio(F.col("tp"), F.col("real"), 4).alias("recall"), ratio(2 * F.col("tp"), F.col("said") + F.col("real"), 4).alias("f1"))


def save(model: PipelineModel, folder: str, user_id: str) -> str:
    """Vectoriser and model as one, under the user's id."""
    model.write().overwrite().save(path := f"{folder}/{user_id}")
    return path


def load(folder: str, user_id: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{user_id}")
