"""N-gram Jaccard self-join: prefix keys bring sets together, size-banded tiles with bitmap signatures pick the pairs worth an exact intersection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailquarry.llm._graph import components
from mailquarry.llm._runtime import stage
from mailquarry.llm._words import mixed, shingle_sets

WORDS = 5
PERCENT = 80
#: Documents of the sample that tells frequent shingles, and how many of these are told at most. They only set the order in which
#: a set's shingles are tried; any order gives the same links.
ORDER_SAMPLE = 4000
ORDER_SHINGLES = 50_000
#: Sets of one tile at most, and bytes of what a tile holds of them.
TILE_ROWS = 4096
TILE_BYTES = 32_000_000
#: Share of a set's keys, in percent, that it must have in common with its first partner to be compared ahead of all others. It decides the order of work only.
AHEAD = 40
#: Classes whose ids are broadcast to fetch their texts, at most (24 bytes each); more are joined by a shuffle of the texts.
BROADCAST_CLASSES = 500_000
#: Bits of a signature for each shingle, at least: of those that are shuffled, and of those made where the shingles are.
SLIM, WIDE = 2, 8
_AT_ONCE = 256


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str | None]]]:
    for at in range(0, batch.num_rows, _AT_ONCE):
        yield at, batch.column(column).slice(at, _AT_ONCE).to_pylist()


def _identity(shingles: np.ndarray) -> int:
    """A set's 64-bit class id."""
    with np.errstate(over="ignore"):
        code = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles)) * np.uint64(0x9E3779B97F4A7C15)
        return int(mixed(np.array([code], np.uint64)).view(np.int64)[0])


def _sampled(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _texts(batch, 0):
                found = np.concatenate([*shingle_sets(texts, words), np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["shingle"])

    return run


def width(n: int | np.ndarray, share: int = SLIM) -> int | np.ndarray:
    """Bits of the signature of a set of n: a power of two, ``share`` times n at least, 256 times ``share`` at least."""
    return share << np.maximum(8, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def signature(shingles: np.ndarray, share: int = SLIM) -> bytes:
    """A set's bitmap: the bits that its shingles hash to."""
    bits = int(width(len(shingles), share))
    flat = np.zeros(bits, np.uint8)
    flat[(shingles >> np.uint64(32)) & np.uint64(bits - 1)] = 1
    return np.packbits(flat, bitorder="little").tobytes()


class Signatures:
    """Signatures of many sets, each also folded to half its width, to be compared with one of that width."""

    def __init__(self, n: np.ndarray, signs: list[bytes], share: int = SLIM) -> None:
        self.n, self.width = n, width(n, share)
        self.at = np.zeros(len(n), np.int64)
        self.full: dict[int, np.ndarray] = {}
        self.half: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.at[rows] = np.arange(len(rows))
            flat = np.frombuffer(b"".join([signs[r] for r in rows]), np.uint64).reshape(len(rows), -1)
            self.full[w] = flat
            self.half[w] = flat[:, : flat.shape[1] // 2] | flat[:, flat.shape[1] // 2 :]

    def most(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Upper bounds of the intersections of the sets x[i] and y[i], y[i] the larger and at most one width up."""
        out = np.zeros(len(x), np.int64)
        for w in np.unique(self.width[x]).tolist():
            for up, source in ((w, self.full), (2 * w, self.half)):
                some = np.flatnonzero((self.width[x] == w) & (self.width[y] == up))
                if len(some):
                    a, b = self.full[w][self.at[x[some]]], source[up][self.at[y[some]]]
                    only_a, only_b = (np.bitwise_count(k).sum(axis=1, dtype=np.int64) for k in (a & ~b, b & ~a))
                    out[some] = np.minimum(self.n[x[some]] - only_a, self.n[y[some]] - only_b)
        return out


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, signs = [], [], []
            for _, texts in _texts(batch, 1):
                for s in shingle_sets(texts, words):
                    sizes.append(len(s))
                    classes.append(_identity(s))
                    signs.append(signature(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(signs, pa.binary())], ["doc_id", "twin", "n", "cls", "sign"])

    return run


def among(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which shingles are frequent ones."""
    if not len(frequent):
        return np.zeros(len(shingles), bool)
    return frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles


def prefix(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, frequent ones last, of which sets that are alike enough share at least one."""
    n = len(shingles)
    keep = n - (percent * n + 99) // 100 + 1
    often = among(shingles, frequent)
    return np.concatenate([shingles[~often], shingles[often]])[:keep]


def _keys(words: int, percent: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in _texts(batch, 0):
                keys, classes, sizes = [np.zeros(0, np.uint64)], [], []
                for s in shingle_sets(texts, words):
                    if len(s) and (cls := _identity(s)) not in seen:
                        seen.add(cls)
                        keys.append(prefix(s, frequent, percent))
                        classes.append((cls, len(keys[-1])))
                        sizes.append(len(s))
                if len(seen) > 1_000_000:  # copies that come later are only joined later
                    seen.clear()
                each = [k for _, k in classes]
                cls = np.repeat(np.array([c for c, _ in classes], np.int64), each)
                flat = np.concatenate(keys)
                columns = [pa.array(flat.view(np.int64)), pa.array(cls), pa.array(np.repeat(np.array(sizes, np.int32), each), pa.int32()), pa.array(among(flat, frequent))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "cls", "n", "often"])

    return run


def _arrays(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cls, shingles) of rows (cls, text); of repeated rows of a task one."""
        seen: set[int] = set()
        for batch in batches:
            fresh = [k for k, cls in enumerate(batch.column(0).to_pylist()) if cls not in seen and not seen.add(cls)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            found = [s.tobytes() for _, texts in _texts(batch, 1) for s in shingle_sets(texts, words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["cls", "shingles"])

    return run


def _alike(n_x: np.ndarray, n_y: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (n_x + n_y - both)


def _band(percent: int) -> float:
    """Logarithm of the width of a band of sizes: sets that are alike are in the same band or in neighbouring ones."""
    return math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-12


class Tile:
    """Rows of a tile in the order of their groups and sizes, and the pairs of them that a link could join."""

    def __init__(self, rows: pa.Table, across: bool, percent: int) -> None:
        rows = rows.sort_by([("low", "ascending"), ("band", "ascending"), ("n", "ascending"), ("cls", "ascending")]).combine_chunks()
        self.rows, self.across, self.percent = rows, across, percent
        self.low, self.band, self.cls, comp, n, self.own, self.block = (rows[c].to_numpy() for c in ("low", "band", "cls", "component", "n", "own", "block"))
        self.n = n.astype(np.int64)
        self.components, self.label = np.unique(comp, return_inverse=True)
        self.given = self.label.copy()
        starts = np.flatnonzero((np.diff(self.low, prepend=~self.low[:1]) != 0) | (np.diff(self.band, prepend=~self.band[:1]) != 0))
        self.ends = np.zeros(len(n), np.int64)
        for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(n)], strict=True):
            # Sizes ascend: the band of a row ends where sizes are too large for it.
            self.ends[first:last] = first + np.searchsorted(self.n[first:last], self.n[first:last] * 100 // percent, "right")

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a group that are not in one component when it is their turn, near ones in the order of sizes first."""
        x, step = np.arange(len(self.n)), 1
        while len(x := x[x + step < self.ends[x]]):
            for at in range(0, len(x), 1 << 14):
                left = x[at : at + (1 << 14)]
                right = left + step
                some = (self.label[left] != self.label[right]) & (self.own[left] | self.own[right])
                if self.across:
                    some &= self.block[left] != self.block[right]
                if some.any():
                    yield left[some], right[some]
            step += 1

    def unite(self, x: int, y: int) -> None:
        """Join the components of two rows."""
        a, b = self.label[x], self.label[y]
        self.label[self.label == max(a, b)] = min(a, b)


def _sized(percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Rows of a tile that have a partner of another component which sizes and numbers of shared keys allow.

        Of two sets, the one whose keys end first in the order has in common with the other only keys and what comes after its keys.
        """
        tile = Tile(rows, key[1].as_py() != key[2].as_py(), percent)
        keys, rest = tile.rows["shared"].to_numpy(), (percent * tile.n + 99) // 100 - 1
        hit = np.zeros(len(tile.n), bool)
        for left, right in tile.pairs():
            most = np.minimum(keys[left], keys[right]) + np.maximum(rest[left], rest[right])
            good = _alike(tile.n[left], tile.n[right], np.minimum(most, np.minimum(tile.n[left], tile.n[right])), percent)
            hit[left[good]] = hit[right[good]] = True
        return tile.rows.select(["low", "band", "cls"]).filter(pa.array(hit))

    return run


def _open(percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Rows (low, band, cls) of a tile that have a partner of another component with enough bits in common."""
        tile = Tile(rows, key[1].as_py() != key[2].as_py(), percent)
        sets = Signatures(tile.n, tile.rows["sign"].to_pylist())
        hit = np.zeros(len(tile.n), bool)
        for left, right in tile.pairs():
            good = _alike(tile.n[left], tile.n[right], sets.most(left, right), percent)
            hit[left[good]] = hit[right[good]] = True
        return tile.rows.select(["low", "band", "cls"]).filter(pa.array(hit))

    return run


def _links(percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Of each component (a) of a tile that links have joined to a smaller one, that one (b): fewer rows than the tile has.

        Bit counts bound the intersections from above; what passes is intersected exactly, unless links found before have joined it.
        """
        tile = Tile(rows, key[1].as_py() != key[2].as_py(), percent)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tile.rows["shingles"]]
        bits = Signatures(tile.n, [signature(x, WIDE) for x in sets], WIDE)
        for left, right in tile.pairs():
            good = _alike(tile.n[left], tile.n[right], bits.most(left, right), percent)
            for x, y in zip(left[good].tolist(), right[good].tolist(), strict=True):
                if tile.label[x] == tile.label[y]:
                    continue
                at = np.searchsorted(sets[y], sets[x])
                both = int((sets[y][np.minimum(at, len(sets[y]) - 1)] == sets[x]).sum())
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    tile.unite(x, y)
        joined, first = np.unique(tile.given, return_index=True)
        joined, to = joined[moved := tile.label[first] != joined], tile.label[first]
        return pa.table({"a": pa.array(tile.components[joined], pa.int64()), "b": pa.array(tile.components[to[moved]], pa.int64())})

    return run


def _tiled(rows: DataFrame, tile_rows: int, unit: float) -> DataFrame:
    """Rows of groups (low, band) as tiles: grp, i, j and the row's block. A set takes ``unit`` bytes for each shingle.

    A group too large for one tile goes by a hash to blocks and to a tile for each two of these, in tasks of their own; small groups share tiles.
    """
    share = F.col("n") * unit / TILE_BYTES + F.lit(1 / tile_rows)
    sizes = stage(rows.groupBy("low", "band").agg(F.sum(share).alias("tiles")).withColumn("blocks", F.ceil("tiles").cast("int")), "groups")
    groups = max(1, math.ceil(sizes.agg(F.sum("tiles")).head()[0] or 0))
    placed = rows.join(sizes.select("low", "band", "blocks"), ["low", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spot = F.xxhash64("low", "band")
    grp = F.when(F.col("blocks") == 1, F.pmod(spot, F.lit(groups))).otherwise(spot).alias("grp")
    return placed.select(*rows.columns, "block", grp, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    tile_rows: int = TILE_ROWS,
    with_groups: bool = False,
) -> DataFrame:
    """Documents linked where their sets of word shingles have a Jaccard similarity of ``percent`` % or more.

    Returns a row per document: doc_id, n_shingles, component_id (the smallest id that links reach). ``with_groups`` adds twin, a hash of the
    text, which parts rows of one id, and group, which is one number for all that links reach, ids or not; null without shingles.

    How: equal sets are one class, whatever their number. With shingles in one global order, two sets that are alike
    enough share one of their first n - ceil(n * percent / 100) + 1; these are the keys. The classes of a key are in the group of its
    smallest class, so a class is in a group once, however many keys lead there. First, each class meets the group in which it has most of its keys
    (``AHEAD`` % at least), which unites near copies. Where a group still has several components, its size bands become tiles: the numbers of keys that sets share with any others, then bit counts
    of signatures bound intersections from above, which leaves the rows worth an exact look; these get their sorted shingles and are intersected. A tile
    returns which components links have joined to which, fewer rows than it has, and leaves out pairs that others have joined already.
    A group of over ``tile_rows`` rows or ``TILE_BYTES`` bytes is split into tiles of two blocks. So every component is found, and no link is assumed.

    Scale: linear in the text and in keys (a fifth of all shingles, 64-bit hashes); frequent shingles, told by a
    bounded sample, come last in the order, so that common passages are no keys. A frequent shingle that is a key meets one broadcast row (``ORDER_SHINGLES`` at most),
    so hot keys stay where they are; all other keys are shuffled once, and windows, which spill, find their smallest classes.
    Texts are shuffled only to fetch those of classes that are compared exactly, twice at most, and not at all where these are ``BROADCAST_CLASSES`` or fewer. Everything between is staged in the shared folder.
    The tiles of a group of m open rows number (m / tile_rows)^2 / 2; rows that one link united before are not open. Classes and shingles are told by
    64-bit hashes: among n distinct sets, n^2 / 2^65 pairs are taken for equal by chance.

    Null or empty texts, and those without words, have no shingles and are linked with nothing. Repeated rows are copies. A null id has a null
    component unless it is linked with a row that has an id. A row that is repeated is one row of its class wherever texts are compared. A
    very long text is one set like any other, and its tile may be its own. An empty table gives no rows. Only the two named columns are read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("twin"))
    sets = stage(rows.mapInArrow(_sets(words), "doc_id long, twin long, n long, cls long, sign binary"), "sets")
    repeated = bool(sets.where("n > 0").groupBy("doc_id", "twin").count().where("count > 1").take(1))
    share = min(1.0, ORDER_SAMPLE / max(1, sets.count()))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "twin"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    counted = picked.select("text").mapInArrow(_sampled(words), "shingle long").groupBy("shingle").count()
    often = counted.where("count >= 8").orderBy(F.desc("count"), "shingle").limit(ORDER_SHINGLES).select("shingle")
    frequent = np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))

    keys = stage(rows.select("text").mapInArrow(_keys(words, percent, frequent), "key long, cls long, n int, often boolean"), "keys")
    of_key = Window.partitionBy("key")
    rare = keys.where("not often").withColumns({"low": F.min("cls").over(of_key), "high": F.max("cls").over(of_key)}).where("low <> high")
    common = keys.where("often")
    lowest = common.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("key", "low")
    common = common.join(F.broadcast(lowest), "key")  # ORDER_SHINGLES rows at most
    led = rare.select("low", "cls", "n").unionByName(common.select("low", "cls", "n"))
    members = stage(led.groupBy("low", "cls").agg(F.count("*").alias("keys"), F.first("n").alias("n")), "members")
    one = sets.where("n > 0").groupBy("cls").agg(F.min(F.struct("doc_id", "twin")).alias("at"), F.min("doc_id").alias("rep"), F.first("sign").alias("sign"))
    classes = stage(one.join(members.select("cls").distinct(), "cls", "left_semi"), "classes")

    def linked(tiles: DataFrame, name: str) -> DataFrame:
        """Joined components (a, b) of tiles; the texts of their classes are fetched by their first documents."""
        wanted = stage(classes.join(tiles.select("cls").distinct(), "cls", "left_semi").select("cls", F.col("at.doc_id").alias("id"), F.col("at.twin").alias("of")), f"{name}_classes")
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_CLASSES else wanted
        texts = rows.join(wanted, (F.coalesce("doc_id", F.lit(0)) == F.coalesce("id", F.lit(0))) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("twin") == F.col("of")))
        arrays = stage(texts.select("cls", "text").mapInArrow(_arrays(words), "cls long, shingles binary"), f"{name}_shingles")
        arrays = arrays.dropDuplicates(["cls"]) if repeated else arrays
        return stage(tiles.join(arrays, "cls").groupBy("grp", "i", "j").applyInArrow(_links(percent), "a long, b long"), f"{name}_links")

    first = members.where("cls <> low").groupBy("cls").agg(F.max_by("low", F.struct("keys", "low")).alias("low"), F.max("keys").alias("keys"), F.first("n").alias("n"))
    first = first.where(F.col("keys") * 10_000 >= F.col("n") * ((100 - percent) * AHEAD)).select("low", "cls", "n")
    lows = first.groupBy("low").agg(F.ceil(F.sum(F.col("n") * 8 / TILE_BYTES + F.lit(1 / tile_rows))).cast("int").alias("blocks"))
    lows = stage(lows, "first_groups")
    head = members.where("cls = low").join(lows, "low").select("low", "cls", "n", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("band"))
    first = first.join(lows, "low").select("low", "cls", "n", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("band")).unionByName(head)
    first = first.withColumns({"component": F.col("cls"), "own": F.lit(True)})
    first = linked(stage(_tiled(first, 2 * tile_rows, 4.0), "first_tiles"), "first")

    part = components(first).withColumnRenamed("id", "cls")
    totals = members.groupBy("cls").agg(F.sum("keys").alias("shared"))
    of_class = stage(totals.join(part, "cls", "left").select("cls", "shared", F.coalesce("component", "cls").alias("component")), "class_components")
    size = F.floor(F.log("n") / _band(percent)).cast("long")
    placed = members.join(of_class, "cls").withColumn("size", size).withColumn("band", F.explode(F.array(F.col("size"), F.col("size") + 1)))
    placed = placed.select("low", "band", "cls", "n", "component", "shared", (F.col("size") == F.col("band")).alias("own"))
    crossed = placed.groupBy("low", "band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("own").alias("own")).where("own and x <> y")
    placed = stage(placed.join(stage(crossed.select("low", "band"), "crossed"), ["low", "band"]), "open_rows")
    triple = "low long, band long, cls long"
    sized = stage(_tiled(placed, tile_rows, 0.0).groupBy("grp", "i", "j").applyInArrow(_sized(percent), triple), "sized_rows").distinct()
    placed = stage(placed.join(sized, ["low", "band", "cls"]), "sized_tiles")
    signed = _tiled(placed, tile_rows, 0.5).join(classes.select("cls", "sign"), "cls")
    near = stage(signed.groupBy("grp", "i", "j").applyInArrow(_open(percent), triple), "near_rows").distinct()
    near = stage(placed.join(near, ["low", "band", "cls"]), "near_tiles")
    second = linked(stage(_tiled(near, tile_rows, 8.0), "second_tiles"), "second")

    joined = components(second).select(F.col("id").alias("component"), F.col("component").alias("further"))
    part = of_class.join(joined, "component", "left").select("cls", F.coalesce("further", "component").alias("component"))
    reps = stage(sets.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep")), "representatives")
    least = stage(part.join(reps, "cls").groupBy("component").agg(F.min("rep").alias("least")), "least_ids")
    of_part = part.join(least, "component").select("cls", "component", "least")
    ids = reps.join(of_part, "cls", "left").select("cls", F.coalesce("least", "rep").alias("component_id"), F.coalesce("component", "cls").alias("group"))
    found = sets.select("doc_id", "twin", "n", "cls").join(stage(ids, "component_ids"), "cls", "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    more = ["twin", F.when(F.col("n") > 0, F.col("group")).alias("group")] if with_groups else []
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"), *more)


def kept_rows(groups: DataFrame) -> DataFrame:
    """(doc_id, twin) of the rows that stay of a result ``with_groups``: of each group the one of the smallest id, then of the smallest text hash, null ids last; and all without shingles. Each once."""
    one = groups.where("group IS NOT NULL").groupBy("group").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "twin")).alias("at"))
    return one.select("at.doc_id", "at.twin").unionByName(groups.where("group IS NULL").select("doc_id", "twin").distinct())
