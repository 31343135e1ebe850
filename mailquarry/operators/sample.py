"""Static labels and contiguous samples."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.operators import ranks


def with_label(df: DataFrame, label: str) -> DataFrame:
    """A constant label on every row."""
    return df.withColumn("label", F.lit(label))


def start_share(seed: int) -> float:
    """Where a sample starts, as a share of all possible starts."""
    return random.Random(seed).random()


def _ends(df: DataFrame, order: list[Column], first: int, last: int, path: str) -> tuple:
    """The order columns of the rows of two ranks."""
    rows = ranks.placed(df.select(*order), [F.col(c) for c in df.select(*order).columns], path)
    low, high = ranks.at_ranks(rows, [first, last])
    return tuple(low)[:-1], tuple(high)[:-1]


def contiguous(df: DataFrame, key: str, n: int, seed: int, folder: str) -> DataFrame:
    """``n`` rows that follow each other in the order of ``key``, from a seeded random start; all rows with a key if there are no more.

    Rows of equal key follow each other in the order of a hash of their columns, and rows that are equal altogether are
    interchangeable; rows without key are left out. An empty table gives no rows.

    Scale: keys alone are dealt into ranges and written under ``folder``; counts per range tell the one or two ranges that hold the
    first and the last rank, and only these two rows are read. Other columns are read for the sample only. A hot key
    spreads over ranges; the rows of the two outermost keys are dealt by their hash in turn, if the sample ends amid them.
    """
    df = df.where(F.col(key).isNotNull())
    total = df.count()
    if n >= total or n <= 0:
        return df.limit(max(0, n)) if n <= 0 else df
    start = int(start_share(seed) * (total - n + 1))
    (first,), (last,) = _ends(df, [F.col(key)], start, start + n - 1, f"{folder}/keys")
    found = df.where(F.col(key).between(F.lit(first), F.lit(last)))
    if found.count() == n:
        return found
    # The sample ends amid rows of one key: the same again over (key, hash) of the rows found.
    start -= df.where(F.col(key) < F.lit(first)).count()
    order = F.struct(F.col(key).alias("k"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h"))
    low, high = _ends(found, [order["k"].alias("k"), order["h"].alias("h")], start, start + n - 1, f"{folder}/ties")
    bound = lambda end: F.struct(F.lit(end[0]).cast(df.schema[key].dataType).alias("k"), F.lit(end[1]).alias("h"))
    if low == high:
        return found.where(order == bound(low)).limit(n)
    n_less = found.where(order < bound(low)).count()
    inside = found.where((order > bound(low)) & (order < bound(high)))
    n_low = found.where(order == bound(low)).count() - (start - n_less)
    n_high = n - n_low - inside.count()
    return inside.unionByName(found.where(order == bound(low)).limit(n_low)).unionByName(found.where(order == bound(high)).limit(n_high))
