"""Near duplicates among embeddings by Euclidean p-stable hashing, and exact top-k search by norm buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailquarry.llm._graph import components
from mailquarry.llm._runtime import stage

MIN_COSINE = 0.9
#: Width of the quantised projections of normalised vectors, and how many tables of them are kept at least.
WIDTH = 2.0
TABLES = 24
#: Chance with which a pair of the least cosine shall meet in some table.
RECALL = 0.95
#: Cells of projections that are computed at once.
_CELLS = 2_000_000
#: Vectors that meet in a bucket are compared in blocks of so many.
BLOCK = 2048
SEED = 20_011


def usable(vec: Column) -> Column:
    """A vector with components, all of them finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def hashes_per_table(n: int) -> int:
    """Projections joined into one bucket key: enough that a bucket holds a few vectors that have nothing in common."""
    unlike = 0.4861  # chance that one projection of width 2 agrees for orthogonal vectors
    return max(2, math.ceil(math.log(max(n, 8) / 8) / -math.log(unlike)))


def agreement(cosine: float, width: float) -> float:
    """The chance that one projection puts two normalised vectors of this cosine into the same cell."""
    distance = math.sqrt(max(0.0, 2 - 2 * cosine))
    if not distance:
        return 1.0
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def tables_for(hashes: int, min_cosine: float = MIN_COSINE, width: float = WIDTH, recall: float = RECALL) -> int:
    """Tables of so many joined projections in which a pair of ``min_cosine`` meets at least once with the chance ``recall``."""
    meet = agreement(min_cosine, width) ** hashes
    return TABLES if meet >= 1 else max(TABLES, math.ceil(math.log1p(-recall) / math.log1p(-meet)))


def bucket_keys(vectors: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """A 32-bit bucket key per vector and table: floor((a x + b) / width) for Gaussian a and uniform b, joined."""
    rng = np.random.default_rng(seed + vectors.shape[1])
    a = rng.standard_normal((vectors.shape[1], tables * hashes))
    b = rng.uniform(0, width, tables * hashes)
    out = np.zeros((len(vectors), tables), np.uint32)
    step = max(1, _CELLS // (tables * hashes))
    for at in range(0, len(vectors), step):
        cells = np.floor((vectors[at : at + step] @ a + b) / width).astype(np.int64).reshape(-1, tables, hashes)
        key = np.zeros(cells.shape[:2], np.uint64)
        for j in range(hashes):
            key = (key ^ cells[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[at : at + step] = key >> np.uint64(32)
    return out


def _bucketed(tables: int, hashes: int, width: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x = _matrix(part.column(1))
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = bucket_keys(x, tables, hashes, width, seed)
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), pa.array(keys.astype(np.int32).ravel(), pa.int32()))
                units = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([int(size)] * len(x), pa.int32()), units, lists], ["cls", "dim", "unit", "keys"])

    return run


def _local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that links reach, for each of n."""
    label = np.arange(n)
    while True:
        fresh = label.copy()
        np.minimum.at(fresh, left, label[right])
        np.minimum.at(fresh, right, label[left])
        fresh = fresh[fresh]
        if np.array_equal(fresh, label):
            return label
        label = fresh


def _linked(min_cosine: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Links of a tile, within each of its buckets or between the two blocks of one, of pairs that meet in no earlier table."""
        i, j = key[1].as_py(), key[2].as_py()
        rows = rows.sort_by([(c, "ascending") for c in ("t", "key", "dim", "block", "cls")]).combine_chunks()
        cls, weight, table, bucket, dim, block = (rows[c].to_numpy() for c in ("cls", "n", "t", "key", "dim", "block"))
        flat, keys = rows["unit"].combine_chunks().flatten().to_numpy(), _matrix(rows["keys"]).astype(np.int64)
        at = np.cumsum(dim) - dim
        fresh = (np.diff(table, prepend=-1) != 0) | (np.diff(bucket, prepend=~bucket[:1]) != 0) | (np.diff(dim, prepend=-1) != 0)
        starts = np.flatnonzero(fresh)
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(cls)], strict=True):
            size, t = int(dim[first]), int(table[first])
            x = flat[at[first] : at[first] + size * (last - first)].reshape(-1, size)
            cut = last - first if i == j else int(np.searchsorted(block[first:last], j))
            beyond = 0 if i == j else cut
            for row in range(0, cut, 512):
                a, b = np.nonzero(x[row : min(row + 512, cut)] @ x[beyond:].T >= min_cosine)
                a, b = a + row, b + beyond
                a, b = a[a < b] + first, b[a < b] + first
                if len(a):
                    met = (keys[a, :t] == keys[b, :t]).any(axis=1)
                    lefts.append(a[~met])
                    rights.append(b[~met])
        a, b = np.concatenate(lefts), np.concatenate(rights)
        links = np.bincount(a, weight[b], len(cls)) + np.bincount(b, weight[a], len(cls))
        near = _local_components(len(cls), a, b)
        some = np.flatnonzero(links)
        return pa.table({"cls": pa.array(cls[some], pa.int64()), "links": pa.array(links[some].astype(np.int64)), "near": pa.array(cls[near[some]], pa.int64())})

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    min_cosine: float = MIN_COSINE,
    tables: int | None = None,
    width: float = WIDTH,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """Vectors whose cosine is at least ``min_cosine``, linked: vec_id, n_links, component_id, kept.

    Normalised vectors fall into one bucket per table, by several joined projections of Gaussian directions. There
    are as many tables (``tables``, if not given) as it takes that two vectors of cosine ``min_cosine`` share at
    least one bucket with a chance of 0.95, whatever the number of vectors; closer ones meet more often. Cosines
    of those that meet are then computed in double precision, so no link is wrong. A pair counts in the
    first table in which it meets.

    Scale: equal vectors are one class with a count, whatever their number. The number of projections per
    table grows with the logarithm of the classes, so buckets stay small; the number of tables grows with a small
    power of the classes, and what is shuffled with it. A bucket over ``block``
    vectors is compared as tiles of two blocks each, in separate tasks. Tiles give counts and
    one edge per linked vector, never pairs.

    Null, zero or non-finite vectors have no links and are their own component, as have vectors whose
    length no other shares. A row without id takes no part: no links, null component, not kept. Rows of one id are vectors of their
    own, which are counted each and share the id's name. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vec_col), lambda x: x.cast("double") + 0.0).alias("v"))
    rows = rows.withColumn("ok", F.col("vec_id").isNotNull() & usable(F.col("v")) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    good = rows.where("ok").select("vec_id", "v")
    member = stage(good.select("vec_id", F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256).alias("same"), "v"), "vectors")
    classes = stage(member.groupBy("same").agg(F.min("vec_id").alias("cls"), F.count("*").alias("n"), F.first("v").alias("v")), "classes")
    hashes = hashes_per_table(classes.count())
    tables = tables_for(hashes, min_cosine, width) if tables is None else tables
    units = classes.select("cls", "v").mapInArrow(_bucketed(tables, hashes, width, seed), "cls long, dim int, unit array<double>, keys array<int>")
    units = stage(units.join(classes.select("cls", "n"), "cls"), "units")
    meets = units.select("cls", F.posexplode("keys").alias("t", "key"), "dim")
    full = stage(meets.groupBy("t", "key", "dim").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    # Tiles of a bucket: (i, j) for blocks i <= j; a vector of block i goes to all tiles that name i.
    full = full.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = meets.join(full, ["t", "key", "dim"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = placed.withColumn("other", F.explode(others))
    # Small buckets share a tile, of about ``block`` rows; a bucket of several blocks has tiles of its own.
    groups = max(1, (full.agg(F.sum("size")).head()[0] or 0) // block)
    spot = F.xxhash64("t", "key", "dim")
    group = F.when(F.col("blocks") == 1, F.pmod(spot, F.lit(groups))).otherwise(spot).alias("grp")
    placed = placed.select("cls", "t", "key", "dim", "block", group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    tiles = placed.join(units.select("cls", "unit", "keys", "n"), "cls")
    found = stage(tiles.groupBy("grp", "i", "j").applyInArrow(_linked(min_cosine), "cls long, links long, near long"), "links")
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("cls").alias("a"), F.col("near").alias("b")))
    grown = classes.select("same", "cls", "n").join(linked, "cls", "left").join(parts.withColumnRenamed("id", "cls"), "cls", "left")
    grown = grown.select("same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component_id"))
    linked_rows = member.select("vec_id", "same").join(grown, "same").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


TOP = 10
SCALE = 1024
QUERY_EVERY = 100
QUERY_BLOCK = 1024
ROW_BLOCK = 8192
#: Norms of a bucket lie within this factor.
NORM_STEP = 1.05
#: Least cosine that a bucket must promise for a query before single coordinates are worth a look.
COORDINATE_FROM = 0.5
_EXACT = 2.0**53


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole numbers held as doubles; beyond 64 bits they stop at the limit."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    bound = np.abs(q).max() * np.abs(x).max() * q.shape[1]
    if bound < _EXACT:
        return (q @ x.T).astype(np.int64)
    if bound < 2.0**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    big = np.array([[int(v) for v in r] for r in q], object) @ np.array([[int(v) for v in r] for r in x], object).T
    limit = 2**63 - 1
    return np.array([[max(-limit - 1, min(limit, v)) for v in r] for r in big], np.int64).reshape(len(q), len(x))


def _best(top: int):
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        """The best ``top`` products of each query of a block with the vectors of one block of a norm bucket.

        A query whose best products so far are at least ``theta`` needs cosine theta / (its norm * the
        bucket's largest norm) here. Over 1 the bucket is skipped; if it is high, vectors are dropped whose value on
        the query's largest coordinate rules that cosine out; else those that are too short.
        """
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and rows.num_rows:
            rows = rows.sort_by([("norm", "descending"), ("vec_id", "ascending")])
            ids, x, norms = rows["vec_id"].to_numpy(), _matrix(rows["v"]), rows["norm"].to_numpy()
            units = x / np.maximum(norms, 1e-300)[:, None]
            qids, q, lengths = queries["vec_id"].to_numpy(), _matrix(queries["v"]), queries["norm"].to_numpy()
            theta = queries["theta"].to_numpy(zero_copy_only=False).astype(np.float64)
            for i in range(len(qids)):
                need, at = theta[i], slice(None)
                if need > 0:
                    cosine = need / (lengths[i] * norms[0]) - 1e-9 if norms[0] > 0 else 2.0
                    if cosine > 1:
                        continue
                    long_enough = int(np.searchsorted(-norms, -(need / lengths[i]) * (1 - 1e-9), "right"))
                    at = slice(0, long_enough)
                    if cosine >= COORDINATE_FROM:
                        f = int(np.argmax(np.abs(q[i])))
                        u = q[i, f] / lengths[i]
                        slack = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - u * u))) + 1e-9
                        low = u * cosine - slack if u * cosine - slack > -1 and u <= cosine else -1.0
                        high = u * cosine + slack if -u <= cosine else 1.0
                        low, high = (low, 1.0 + 1e-9) if u >= 0 else (-1.0 - 1e-9, high)
                        at = np.flatnonzero((units[:long_enough, f] >= low) & (units[:long_enough, f] <= high))
                found, products = ids[at], _products(q[i : i + 1], x[at])[0]
                other = (found != qids[i]) & (products >= need if need == need else True)
                found, products = found[other], products[other]
                if len(found) > top:
                    enough = np.partition(products, len(products) - top)[len(products) - top]
                    some = np.flatnonzero(products >= enough)
                    found, products = found[some], products[some]
                order = np.lexsort((found, -products))[:top]
                out.append((np.full(len(order), qids[i]), found[order], products[order]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def _pairs(queries: DataFrame, bands: DataFrame, query_block: int) -> tuple[DataFrame, DataFrame]:
    """Queries with need and their block q; and the pairs (dim, need, q, band) of query blocks and norm buckets that may hold answers.

    A query needs vectors of norm theta / its own norm at least. Queries of like needs share blocks, so a block leaves out every bucket whose
    largest norm is under the least need of it, before anything is shuffled for the pair.
    """
    least = F.when((F.col("theta") > 0) & (F.col("norm") > 0), F.col("theta") / F.col("norm")).otherwise(F.lit(0.0))
    level = F.when(F.col("least") > 0, F.floor(F.log("least") / math.log(NORM_STEP))).otherwise(F.lit(-(10**6))).cast("int")
    needy = queries.withColumn("least", least).withColumn("need", level)
    sizes = needy.groupBy("dim", "need").agg(F.ceil(F.count("*") / query_block).cast("int").alias("q_blocks"))
    placed = needy.join(sizes, ["dim", "need"]).withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("q_blocks")).cast("int"))
    lows = placed.groupBy("dim", "need", "q").agg(F.min("least").alias("least"))
    pairs = lows.join(bands, "dim").where(F.col("least") <= F.col("top") * (1 + 1e-9))
    return placed.drop("q_blocks"), pairs.select("dim", "need", "q", "band", "blocks", "from", "to")


def _matched(candidates: DataFrame, queries: DataFrame, bands: DataFrame, top: int, query_block: int) -> DataFrame:
    """Products (query_id, vec_id, score) of queries (vec_id, v, norm, dim, theta) with the blocks ``from`` to ``to`` of norm buckets, a task per pair of blocks that may hold answers."""
    placed, pairs = _pairs(queries, bands, query_block)
    pairs = stage(pairs, "block_pairs")
    grid = ["dim", "need", "q", "band", "block"]
    spread = placed.join(pairs, ["dim", "need", "q"]).withColumn("block", F.explode(F.sequence(F.col("from"), F.col("to") - 1)))
    wanted = pairs.groupBy("dim", "band").agg(F.first("blocks").alias("blocks"), F.first("from").alias("from"), F.first("to").alias("to"), F.collect_list(F.struct("need", "q")).alias("asking"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    rows = candidates.join(wanted, ["dim", "band"]).withColumn("block", block).where((F.col("block") >= F.col("from")) & (F.col("block") < F.col("to")))
    rows = rows.select("vec_id", "v", "norm", "dim", "band", "block", F.explode("asking").alias("a")).select("vec_id", "v", "norm", "dim", "band", "block", "a.need", "a.q")
    spread = spread.select("vec_id", "v", "norm", "theta", *grid)
    return spread.groupBy(*grid).cogroup(rows.groupBy(*grid)).applyInArrow(_best(top), "query_id long, vec_id long, score long")


def top_products(
    vectors: DataFrame,
    queries: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    top: int = TOP,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """Each query's ``top`` highest integer inner products, exactly: query_id, rank, vec_id, score.

    A component x counts as floor(scale * x). Queries are the rows for which ``queries`` holds (by default, ids
    divisible by 100), candidates all other rows of the same length; ties go to the smaller id. Vectors that are null,
    or hold null or non-finite components, take no part; empty vectors have none to multiply and take
    none either, nor do rows without id. Rows of one id count as one vector, the least of them. An empty table gives no rows.

    Scale: vectors are grouped by norm, and by blocks within a norm; queries are in blocks too. A first pass over one block of each of the
    highest norm buckets, as many as have ``row_block`` vectors together, gives each query a product that its answers must reach;
    then queries of like needs go to blocks together, buckets too short for a whole query block are left out in the plan, before anything is
    shuffled for them, and each other pair of blocks is a task of its own that prunes by it and returns only products that reach it. Tables joined to the
    vectors have one row per norm bucket, so a bucket of all vectors splits. Where all norms are alike no bucket can be left out: a search without an index then
    sends the vectors once per query block.
    """
    given = queries if queries is not None else F.pmod(F.col(id_col), F.lit(QUERY_EVERY)) == 0
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"), F.coalesce(given, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).withColumn("dim", F.size("v"))
    rows = stage(rows.withColumn("band", F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(NORM_STEP))).otherwise(-1).cast("int")), "whole_vectors")
    bands = rows.groupBy("dim", "band").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / row_block).cast("int").alias("blocks"), F.max("norm").alias("top"))
    higher = Window.partitionBy("dim").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = stage(bands.withColumn("leads", F.coalesce(F.sum("rows").over(higher), F.lit(0)) < row_block).drop("rows"), "bands")
    asked = stage(rows.where("asks").select("vec_id", "v", "norm", "dim"), "queries")
    candidates = rows.select("vec_id", "v", "norm", "dim", "band")
    first = stage(_matched(candidates, asked.withColumn("theta", F.lit(None).cast("double")), bands.where("leads").withColumn("from", F.lit(0)).withColumn("to", F.lit(1)), top, query_block), "first_products")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
    reach = ranked.where(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("theta"))
    known = stage(asked.join(reach, "vec_id", "left"), "bounded_queries")
    rest = bands.withColumn("from", F.when(F.col("leads"), 1).otherwise(0)).withColumn("to", F.col("blocks")).where(F.col("from") < F.col("to"))
    found = first.unionByName(_matched(candidates, known, rest, top, query_block))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


#: The same search in DuckDB.
TOP_SQL = """
WITH whole AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10
"""
