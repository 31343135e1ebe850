"""JSON-lines, CSV and text edges of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailquarry.sources.schema import PARSED


def read_parsed(spark: SparkSession, path: str | list[str], corrupt: str | None = None) -> DataFrame:
    """Parsed mails from JSON lines; a fixed schema, so the files are read once.

    ``corrupt`` names a column that has the text of lines that cannot be read; without it they are rows of nulls.
    """
    if corrupt is None:
        return spark.read.schema(PARSED).json(path)
    return spark.read.schema(f"{PARSED}, `{corrupt}` string").option("columnNameOfCorruptRecord", corrupt).json(path)


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Named columns of CSV files with headers; a missing one is an error."""
    df = spark.read.option("header", True).option("encoding", encoding).option("escape", '"').option("multiLine", True).csv(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*columns)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines in UTF-8."""
    df.write.mode(mode).json(path)


def write_wordlist(urls: DataFrame, path: str, mode: str = "errorifexists", column: str = "url") -> None:
    """One URL per line."""
    urls.select(column).write.mode(mode).text(path)
