"""Places in the order of a whole table, by ranges: no task ever sees more than one range of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Low bits of ``monotonically_increasing_id``: the row's number in its partition; the partition's number stands above them.
ROW_BITS = 33


def placed(df: DataFrame, order: Sequence[Column], path: str, at: str = "at") -> DataFrame:
    """``df`` written to ``path`` in ranges of ``order``, each sorted, with a column ``at`` that grows along the order.

    Range bounds come from Spark's sample. Rows that ``order`` leaves equal follow each other as they are read, so many equal
    rows are dealt over several ranges too. One shuffle.
    """
    tie = F.col("tie_row")
    rows = df.withColumn("tie_row", F.monotonically_increasing_id()).repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    rows = rows.drop("tie_row").withColumn(at, F.monotonically_increasing_id())
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def offsets(rows: DataFrame, at: str = "at") -> list[tuple[int, int, int]]:
    """(range, rows before it, its rows) of every range of ``placed`` rows, in order; as few as there are ranges."""
    counts = rows.groupBy(F.shiftright(at, ROW_BITS).alias("range")).agg(F.count("*").alias("n")).collect()
    out, before = [], 0
    for r in sorted(counts):
        out.append((r["range"], before, r["n"]))
        before += r["n"]
    return out


def ranked(rows: DataFrame, at: str = "at", rank: str = "rank") -> DataFrame:
    """``placed`` rows with their rank from 0: the rows of earlier ranges, and the number in the own one. No shuffle."""
    table = rows.sparkSession.createDataFrame([(r, before) for r, before, _ in offsets(rows, at)], "rank_range long, rank_before long")
    joined = rows.join(F.broadcast(table), F.shiftright(at, ROW_BITS) == F.col("rank_range"))
    number = F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return joined.withColumn(rank, F.col("rank_before") + number).drop("rank_range", "rank_before")


def at_ranks(rows: DataFrame, ranks: Sequence[int], at: str = "at") -> list:
    """The ``placed`` rows of a few ranks, in the order of the ranks: only the ranges that hold them are read."""
    found = []
    table = offsets(rows, at)
    for rank in ranks:
        part, before = next((r, before) for r, before, n in table if before <= rank < before + n)
        found.append((part << ROW_BITS) + rank - before)
    got = {r[at]: r for r in rows.where(F.col(at).isin(found)).collect()}
    return [got[x] for x in found]
