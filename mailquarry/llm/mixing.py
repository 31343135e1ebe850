"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailquarry.llm._runtime import spare, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Rows of one slice of the sources' shuffled orders, on average.
SLICE_ROWS = 200_000
_HASH_BITS = 60


def shuffled(id_col: Column, seed: str = "") -> Column:
    """A document's place in the shuffled order: 60 bits of a hash of its id."""
    text = F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def sources(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """A row per source: source, source_size, source_rank, weight, target, level, budget.

    The budget is the sum of all sizes. A source's share goes by its weight, but stops at max_epochs times
    its size; what it leaves is shared again by weight. ``level`` is the virtual time at which a fluid
    fair queue has served the budget, so target = least(weight * level, max_epochs * source_size).
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("source_rank", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(cycle, F.pmod("source_rank", F.lit(len(weights)))))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(max_epochs))
    ranked = ranked.withColumn("ends", F.col("most") / F.col("weight"))
    up = Window.orderBy("ends", "source_rank")
    everything = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ended = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    queued = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = ranked.withColumn("budget", F.sum("source_size").over(everything)).withColumn("ended", ended).withColumn("queued", queued)
    ranked = ranked.withColumn("level_if_next", (F.col("budget") - F.col("ended")) / F.col("queued"))
    level = F.max(F.when(F.col("level_if_next") <= F.col("ends"), F.col("level_if_next"))).over(everything)
    ranked = ranked.withColumn("level", level)
    target = F.when(F.col("ends") < F.col("level"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return ranked.select("source", "source_size", "source_rank", "weight", target.alias("target"), "level", "budget")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The mix of all sources: a row per copy of a document, with ``taken`` 0 or the words it gives.

    Sources by code point, null last, weigh ``weights`` in turn. Each source's documents are shuffled by a
    hash of their ids; a copy's virtual finish time is the words of its source up to its end, earlier epochs
    included, divided by the weight. The copies are sorted by it, over all sources, and
    taken until the next one would exceed the budget, which is the words of all documents.
    Epochs that a source begins after the queue has served the budget are left out.

    Returns row_id, doc_id, source, size, source_size, target, weight, epoch, finish, place (range of the
    sort), taken. Every document has its epoch 0. Reruns agree.

    Scale: texts are read once, to count their words; a slim table (id, source, size) is staged. Running sums
    have two levels: slices, ranges of (source, hash, id, size, row), as many as the input needs, then rows
    within a slice; and ranges of the finish time, then rows within a range. So neither a hot source, nor one id that many rows have, nor the
    whole order lands in one task. Only the list of sources, and for each the list of its slices, are
    windows of their own.

    A null text has size 0; null ids and null sources are kept; repeated rows are documents of
    their own; ties of finish go by source, epoch, hash, id, size, row. Very long texts are counted like others. An empty table gives no rows.
    """
    slim = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shuffled(F.col(id_col), seed).alias("h"),
    )
    slim = stage(slim, "sizes")
    n_rows = slim.count()
    n_slices = max(1, min(n_rows // 1_000, docs.sparkSession.sparkContext.defaultParallelism), n_rows // slice_rows)
    known = F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit("")))
    table = sources(slim, weights, max_epochs).withColumn("known", known).drop("source")
    # Slices are ranges of the whole order, row numbers included, so rows of one id are dealt over several like any others.
    order = ["h", "doc_id", "size", "row_id"]
    sliced = slim.withColumn("known", known).repartitionByRange(n_slices, "known", *order).withColumn("slice", F.spark_partition_id())
    sliced = stage(sliced, "slices")
    earlier = Window.partitionBy("known").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sliced.groupBy("known", "slice").agg(F.sum("size").alias("words"))
    slices = slices.select("known", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")).join(table, "known")
    within = Window.partitionBy("known", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sliced.withColumn("upto", F.sum("size").over(within)).join(slices, ["known", "slice"])

    epochs = F.filter(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: (e == 0) | (e * F.col("source_size") < F.col("weight") * F.col("level")))
    copies = placed.withColumn("epoch", F.explode(epochs))
    copies = copies.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("before") + F.col("upto")) / F.col("weight"))
    ranges = copies.repartitionByRange("finish", "source_rank", "epoch", *order).withColumn("place", F.spark_partition_id())
    ranges = stage(ranges.drop("known", "slice", "before", "upto"), "finish")
    sums = ranges.groupBy("place").agg(F.sum("size").alias("words"))
    sums = sums.select("place", F.coalesce(F.sum("words").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("served"))
    order = Window.partitionBy("place").orderBy("finish", "source_rank", "epoch", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = ranges.withColumn("run", F.sum("size").over(order)).join(sums, "place")
    taken = F.when(F.col("served") + F.col("run") <= F.col("budget"), F.col("size")).otherwise(F.lit(0)).cast("long")
    return ordered.select("row_id", "doc_id", "source", "size", "source_size", "target", "weight", "epoch", "finish", "place", taken.alias("taken"))


def mixed_sizes(copies: DataFrame) -> DataFrame:
    """A row per document of a mix: row_id, doc_id, size, source_size, target, taken."""
    same = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    return copies.groupBy("row_id").agg(*same, F.sum("taken").alias("taken"))


def mixed_documents(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with every row as often as its mix ``copies`` takes it; documents without words stay once.

    Rows of one id and source are told apart by number, in the order of a hash of their texts, so each of them gets the copies of one, and the same ones in
    a rerun; rows that are equal get as many in all. Texts are shuffled once, very long ones too. Null ids and sources count as values, a null text is a row
    without words. An empty table or mix gives no rows. Columns of any name are kept.
    """
    of_id, of_source, of_row, times, row, copy = spare(docs, "mix_id", "mix_source", "mix_row", "mix_times", "doc_row", "mix_copy")
    took = (F.col("taken") > 0) | ((F.col("size") == 0) & (F.col("epoch") == 0))
    wanted = copies.where(took).groupBy("row_id").agg(F.first("doc_id").alias(of_id), F.first("source").alias(of_source), F.count("*").cast("int").alias(times))
    wanted = wanted.withColumn(of_row, F.row_number().over(Window.partitionBy(of_id, of_source).orderBy(F.desc(times), "row_id"))).drop("row_id")
    numbered = docs.withColumn(row, F.row_number().over(Window.partitionBy(id_col, source_col).orderBy(F.xxhash64(text_col))))
    same = F.col(id_col).eqNullSafe(F.col(of_id)) & F.col(source_col).eqNullSafe(F.col(of_source)) & (F.col(row) == F.col(of_row))
    repeated = numbered.join(wanted, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*docs.columns)


#: The same mix in DuckDB.
SQL = r"""
WITH slim AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
         row_number() OVER () AS row_id
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS source_rank
  FROM slim GROUP BY source),
weighed AS (
  SELECT *, CAST(source_rank % 3 + 1 AS DOUBLE) AS weight, source_size * 3 AS most FROM per_source),
queue AS (
  SELECT *, CAST(most AS DOUBLE) / weight AS ends FROM weighed),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
         (CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(most) OVER (ORDER BY ends, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
         / sum(weight) OVER (ORDER BY ends, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_if_next
  FROM queue),
level AS (SELECT max(level_if_next) AS level FROM levels WHERE level_if_next <= ends),
sources AS (
  SELECT source, source_size, source_rank, weight, level, budget,
         CASE WHEN ends < level THEN CAST(most AS DOUBLE) ELSE weight * level END AS target
  FROM levels, level),
placed AS (
  SELECT slim.*, s.source_size, s.source_rank, s.weight, s.level, s.budget, s.target,
         CAST(sum(size) OVER (PARTITION BY slim.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM slim JOIN sources s ON slim.source IS NOT DISTINCT FROM s.source),
copies AS (
  SELECT placed.*, e.epoch, CAST(e.epoch * source_size + upto AS DOUBLE) / weight AS finish
  FROM placed, (VALUES (0), (1), (2)) e(epoch)
  WHERE e.epoch = 0 OR e.epoch * source_size < weight * level),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_rank, epoch, h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM copies)
SELECT any_value(doc_id) AS doc_id, CAST(any_value(size) AS BIGINT) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN run <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM ordered GROUP BY row_id
"""
