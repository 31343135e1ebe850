"""JSON lines to a flat table or CSV with the union of all keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailquarry.operators.profile import json_map

#: Keys that become columns at most: the most frequent, ties by name. The others stay together in one column.
MAX_COLUMNS = 2_000
REST = "_rest"


def flat(df: DataFrame) -> DataFrame:
    """All columns by name, as text: lists and structures as JSON."""

    def text(name: str) -> Column:
        column = F.col(f"`{name}`")
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))
        return (F.to_json(column) if nested else column.cast("string")).alias(name)

    return df.select(*map(text, sorted(df.columns)))


def json_union(df: DataFrame, column: str, keep: tuple[str, ...] = (), max_columns: int = MAX_COLUMNS, corrupt: str | None = None) -> DataFrame:
    """Kept columns, then a column of JSON objects as one text column per key that any row has, by name; missing keys are null.

    Two scans: the keys with their counts, combined before they are shuffled, of which ``max_columns`` reach the driver; then the
    values. Keys may hold any characters: they are looked up, not written into paths. If there are more keys, those of fewer rows stay
    together as a JSON object in ``_rest``, so no value is lost. ``corrupt`` names a column for what is neither null nor a JSON object; without it such rows are null throughout.
    """
    counted = df.select(F.explode(F.map_keys(json_map(F.col(column)))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    top = counted.orderBy(F.desc("n"), "key").limit(max_columns + 1).collect()
    names = sorted(r.key for r in top[:max_columns])
    whole = F.col("json_values")
    rows = df.select(*keep, F.col(column).alias("json_text"), json_map(F.col(column)).alias("json_values"))
    columns = [whole[n].alias(n) for n in names]
    if len(top) > max_columns:
        others = F.map_filter(whole, lambda k, _: ~k.isin(names))
        columns.append(F.when(F.size(others) > 0, F.to_json(others)).alias(REST))
    if corrupt:
        columns.append(F.when(whole.isNull(), F.col("json_text")).alias(corrupt))
    return rows.select(*keep, *columns)


def jsonl_to_csv(spark: SparkSession, source: str, target: str, mode: str = "errorifexists", max_columns: int = MAX_COLUMNS, corrupt: str | None = None) -> None:
    """JSON lines as CSV files with a header: every key of any line, sorted; empty where a line lacks it.

    A line that is no JSON object stops the run, unless ``corrupt`` names a column for such lines. Blank lines are left out; white space of values stays.
    """
    lines = spark.read.text(source).where(F.trim("value") != "")
    if corrupt is None:
        told = F.raise_error(F.concat(F.lit("no JSON object: "), F.substring("value", 1, 200)))
        lines = lines.withColumn("value", F.when(json_map(F.col("value")).isNull(), told).otherwise(F.col("value")))
    json_union(lines, "value", max_columns=max_columns, corrupt=corrupt).write.mode(mode).options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(target)
