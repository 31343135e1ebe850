"""Ranks by ranges, and the samples that use them."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailquarry.operators import ranks, sample


def test_ranks_follow_the_order(spark, tmp_path):
    values = [random.Random(3).randrange(50) for _ in range(400)] + [None] * 5
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k int, i int").repartition(7)
    rows = ranks.placed(df, [F.col("k").asc_nulls_last()], str(tmp_path / "a"))
    got = sorted((r["rank"], r.k) for r in ranks.ranked(rows).collect())
    assert [r for r, _ in got] == list(range(len(values)))
    assert [k for _, k in got] == sorted([v for v in values if v is not None]) + [None] * 5
    assert [r.k for r in ranks.at_ranks(rows, [0, 200, 399])] == [sorted(v for v in values if v is not None)[i] for i in (0, 200, 399)]


def test_one_key_is_dealt_over_ranges(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with partitions too large to be put together
    try:
        rows = ranks.placed(spark.range(2000).select(F.lit(1).alias("k"), "id").repartition(4), [F.col("k")], str(tmp_path / "a"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(n for _, _, n in ranks.offsets(rows)) < 1200
    assert ranks.ranked(rows).agg(F.countDistinct("rank"), F.max("rank")).head()[:] == (2000, 1999)


def test_nothing_to_rank(spark, tmp_path):
    rows = ranks.placed(spark.range(0), [F.col("id")], str(tmp_path / "a"))
    assert ranks.ranked(rows).count() == 0 and ranks.offsets(rows) == []


def test_contiguous_sample(spark, tmp_path):
    df = spark.range(100)
    for seed in range(2):
        got = sorted(r.id for r in sample.contiguous(df, "id", 7, seed, str(tmp_path / f"s{seed}")).collect())
        assert len(got) == 7 and got == list(range(got[0], got[0] + 7))
        assert got[0] == int(sample.start_share(seed) * 94)
    assert sample.contiguous(df, "id", 100, 3, str(tmp_path / "all")).count() == 100
    assert sample.contiguous(df, "id", 0, 3, str(tmp_path / "no")).count() == 0
    assert sample.contiguous(df.where("id < 0"), "id", 3, 3, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4])
def test_contiguous_sample_of_ties_and_nulls(spark, tmp_path, n):
    """Ties go by their hash, equal rows as often as the sample takes them, whatever the start."""
    rows = [(1, 0), (2, 1), (2, 2), (2, 2), (2, 3), (3, 4), (None, 5)]
    df = spark.createDataFrame(rows, "k int, i int")
    ordered = [(r.k, r.i) for r in df.where("k IS NOT NULL").orderBy("k", F.xxhash64("k", "i")).collect()]
    for seed in range(2):
        start = int(sample.start_share(seed) * (len(ordered) - n + 1))
        got = sample.contiguous(df, "k", n, seed, str(tmp_path / f"s{seed}")).collect()
        assert Counter((r.k, r.i) for r in got) == Counter(ordered[start : start + n])


def test_sample_plan_has_no_global_sort(spark, sf_dir, tmp_path):
    """The rows of the sample come from a filtered scan: no sort, no exchange, no limit over the table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sample.contiguous(docs, "doc_id", 25, 11, str(tmp_path / "s"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Limit" not in plan and "PushedFilters" in plan
