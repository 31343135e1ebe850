"""Dataset profiles: value counts, list lengths, keys, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailquarry.functions.text import ratio


def _shown(df: DataFrame, name: str) -> Column:
    """A value as text: lists by their length, structures as JSON."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType):
        return F.when(column.isNotNull(), F.concat(F.lit("list_length_"), F.size(column).cast("string")))
    return F.to_json(column) if isinstance(kind, (T.StructType, T.MapType)) else column.cast("string")


def chosen_columns(df: DataFrame, columns: Sequence[str] | None = None, disregard: Sequence[str] = ()) -> list[str]:
    """The given columns, else all but the disregarded ones."""
    unknown = set(columns or ()) | set(disregard)
    if unknown := unknown.difference(df.columns):
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return list(columns) if columns is not None else [c for c in df.columns if c not in set(disregard)]


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, disregard: Sequence[str] = ()) -> DataFrame:
    """(key, value, n): how often each value of each chosen column occurs; nulls are left out, lists count by length.

    One scan of the chosen columns and one shuffle of partial counts.
    """
    names = chosen_columns(df, columns, disregard)
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), _shown(df, c).alias("value")) for c in names])
    rows = df.select(F.explode(pairs).alias("p")).select("p.key", "p.value").where(F.col("value").isNotNull())
    return rows.groupBy("key", "value").agg(F.count("*").alias("n"))


def json_map(column: Column | str) -> Column:
    """A JSON object's top-level keys with their values as text, whatever characters the keys hold; null for what is no JSON object.

    Strings are as they are, numbers by value (1.50 is 1.5), lists and objects compact JSON. An object that repeats a key is none.
    """
    return F.try_variant_get(F.try_parse_json(column), "$", "map<string,string>")


def keys(df: DataFrame, json_column: str | None = None) -> DataFrame:
    """(key): the columns, or the distinct top-level keys of a column of JSON objects."""
    if json_column is None:
        return df.sparkSession.createDataFrame([(c,) for c in df.columns], "key string")
    return df.select(F.explode(F.map_keys(json_map(F.col(json_column)))).alias("key")).distinct()


def json_types(df: DataFrame, json_column: str) -> DataFrame:
    """(key, n, kind): the top-level keys of a column of JSON objects, how many rows have each, and the one type that takes all its values.

    Types that nothing unites are VARIANT. One aggregate: schemas are merged where the rows lie before they are shuffled.
    """
    objects = df.select(F.try_variant_get(F.try_parse_json(F.col(json_column)), "$", "map<string,variant>").alias("m"))
    pairs = objects.select(F.explode("m").alias("key", "value"))
    return pairs.groupBy("key").agg(F.count("*").alias("n"), F.schema_of_variant_agg("value").alias("kind"))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, total, present, pct_missing): rows, rows with a value, and the share without, to two digits; one aggregate."""
    names = chosen_columns(df, columns)
    counted = df.agg(F.count("*").alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"n{i}").alias("present")) for i, c in enumerate(names)])
    each = counted.select("total", F.explode(rows).alias("r")).select("r.key", "total", "r.present")
    return each.withColumn("pct_missing", ratio((F.col("total") - F.col("present")) * 100, F.col("total"), 2))
