"""Character n-grams inside words, vocabularies of the most frequent, and count vectors."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def char_ngrams(text: Column, smallest: int = 3, largest: int = 4, lower: bool = False) -> Column:
    """All n-grams of the words of a text, each word with a blank on either side; by word, then n, then place.

    n-grams never cross words. A padded word shorter than n gives none of that size. Null gives none.
    """
    clean = F.trim(F.regexp_replace(F.coalesce(F.lower(text) if lower else text, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "))
    sizes = F.array(*[F.lit(n) for n in range(smallest, largest + 1)])

    def of_word(word: Column) -> Column:
        padded, length = F.concat(F.lit(" "), word, F.lit(" ")), F.length(word) + 2
        none = F.array().cast("array<string>")
        place = lambda n: F.transform(F.sequence(F.lit(1), length - n + 1), lambda i: F.substring(padded, i, n))
        return F.flatten(F.transform(sizes, lambda n: F.when(length < n, none).otherwise(place(n))))

    return F.flatten(F.transform(F.filter(F.split(clean, " "), lambda w: w != ""), of_word))


def word_ngrams(text: Column, smallest: int = 1, largest: int = 1, lower: bool = True) -> Column:
    """All runs of words of a text, joined by blanks."""
    tokens = F.filter(F.split(F.coalesce(F.lower(text) if lower else text, F.lit("")), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    sizes = F.array(*[F.lit(n) for n in range(smallest, largest + 1)])
    none = F.array().cast("array<string>")
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.flatten(F.transform(sizes, lambda n: F.when(F.size(tokens) < n, none).otherwise(runs(n))))


def vocabulary(df: DataFrame, grams: str, size: int) -> DataFrame:
    """(idx, term, tf): the ``size`` most frequent terms, ties by term; indexes follow the terms' order."""
    counted = df.select(F.explode(grams).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))
    top = counted.orderBy(F.desc("tf"), "term").limit(size)
    terms = F.sort_array(F.collect_list(F.struct("term", "tf")))
    return top.agg(terms.alias("all")).select(F.posexplode("all").alias("idx", "t")).select(F.col("idx").cast("long"), "t.term", "t.tf")


def vectorizer(spark: SparkSession, terms: DataFrame, grams: str, output: str) -> CountVectorizerModel:
    """A model that counts a vocabulary's terms; the vocabulary is as large as its limit at most."""
    names = [r.term for r in terms.orderBy("idx").collect()]
    return CountVectorizerModel.from_vocabulary(names, inputCol=grams, outputCol=output)


def term_counts(df: DataFrame, key: str, grams: str, terms: DataFrame) -> DataFrame:
    """(key, term, n): counts of vocabulary terms in the long form."""
    each = df.select(key, F.explode(grams).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))
    return each.join(terms.select("term"), "term").select(key, "term", "n")


def wide_counts(df: DataFrame, key: str, grams: str, terms: list[str]) -> DataFrame:
    """(key, a column per term): counts, 0 where a row lacks the term; without a shuffle."""
    def times(term: str) -> Column:
        return F.size(F.filter(grams, lambda g: g == F.lit(term))).cast("long").alias(term)

    return df.select(key, *map(times, terms))
