"""Importance resampling towards a target distribution of hashed n-grams, with each distinct line's features computed once."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._runtime import stage, stage_path
from mailquarry.operators import ranks

#: Longest run of words that is a feature, buckets of features, words that a document needs to be drawn, and percent of those documents that are drawn.
MAX_WORDS, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Whether a line has a word.
HAS_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
_CACHE = 500_000
_SEGMENT = "k1 long, k2 long, times long, n_words long, n_features long, ids binary"
_names = ["k1", "k2", "times", "n_words", "n_features", "ids"]


class _Codes(dict):
    """crc32 of words; those of many words are kept, and all forgotten together between two lines."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = zlib.crc32(word)
        return code


def words(text: str | bytes) -> list[bytes]:
    """The words of a text: runs of digits, letters and whatever is not ASCII, A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return _WORD.findall(raw.translate(_LOWER))


def inside(found: list[bytes], max_words: int, codes: _Codes) -> list[int]:
    """crc32 of all runs of 1 to max_words words of one line."""
    out = list(map(codes.__getitem__, found))
    for n in range(2, max_words + 1):
        out += [zlib.crc32(b" ".join(found[i : i + n])) for i in range(len(found) - n + 1)]
    return out


def crossing(lines: list[list[bytes]], max_words: int) -> list[int]:
    """crc32 of the runs of 2 to max_words words that stand on more than one line."""
    flat = list(itertools.chain.from_iterable(lines))
    ends = [e for e in itertools.accumulate(map(len, lines)) if 0 < e < len(flat)]
    out = []
    for n in range(2, max_words + 1):
        starts = {i for e in ends for i in range(max(0, e - n + 1), min(e, len(flat) - n + 1))}
        out += [zlib.crc32(b" ".join(flat[i : i + n])) for i in sorted(starts)]
    return out


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _packed(rows: list[list[int]], buckets: int) -> pa.Array:
    """Bucket numbers of each row as binary."""
    kind = np.dtype(_width(buckets))
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = (np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(counts.sum())) % buckets).astype(kind)
    offsets = np.append(0, np.cumsum(counts) * kind.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def _keys(text: Column) -> list[Column]:
    """128 bits that tell one line from another."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _text_keys(text: Column) -> list[Column]:
    """128 bits for what a text has across its lines."""
    return [F.xxhash64(F.lit("across"), text).alias("k1"), F.xxhash64(F.lit("lines"), text).alias("k2")]


def segments(docs: DataFrame, text_col: str, max_words: int, buckets: int) -> DataFrame:
    """A row per distinct line with words: k1, k2, times (how often it stands in all texts), n_words, n_features, ids (its features' buckets).

    With ``max_words`` over 1, also a row per distinct text for its features across lines, with no words of its own.
    """
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where(F.rlike("line", F.lit(HAS_WORD)))
    lines = lines.groupBy("line").agg(F.count("*").alias("times"))

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            found = [words(x) for x in batch.column(3).to_pylist()]
            rows = []
            for line in found:
                if len(codes) > _CACHE:
                    codes.clear()
                rows.append(inside(line, max_words, codes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(map(len, found), pa.int64()), pa.array(map(len, rows), pa.int64()), _packed(rows, buckets)], _names)

    out = lines.select(*_keys(F.col("line")), "times", "line").mapInArrow(of_lines, _SEGMENT)
    if max_words == 1:
        return out

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [crossing([words(x) for x in t.split("\n")], max_words) for t in batch.column(2).to_pylist()]
            ones, none = np.ones(len(rows), np.int64), np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ones), pa.array(none), pa.array(map(len, rows), pa.int64()), _packed(rows, buckets)], _names)

    texts = docs.where(F.contains(F.col(text_col), F.lit("\n"))).select(*_text_keys(F.col(text_col)), F.col(text_col).alias("text"))
    across = texts.mapInArrow(of_texts, _SEGMENT).where("n_features > 0").groupBy("k1", "k2")
    return out.unionByName(across.agg(F.sum("times").alias("times"), F.first("n_words").alias("n_words"), F.first("n_features").alias("n_features"), F.first("ids").alias("ids")))


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket's features occur: those of a segment, times its occurrences.

    A task adds its segments up and sends a row per bucket; the driver gets ``buckets`` rows at most.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(2).to_pylist()), _width(buckets))
            times = np.repeat(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            total += np.bincount(ids, times, buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.select("times", "n_features", "ids").mapInArrow(added, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the logarithm of target share over source share, smoothed by one each, floored."""
    s_sum, t_sum, n = int(source.sum()), int(target.sum()), len(source)
    ratios = (((t + 1) * (s_sum + n)) / ((s + 1) * (t_sum + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _line_gains(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(k1, k2, real, n_words, n_features, gain) of every segment."""
    width = _width(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(3).to_numpy()
            sums = np.append(0, np.cumsum(gain[np.frombuffer(b"".join(batch.column(4).to_pylist()), width)]))
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums[ends] - sums[ends - counts])], ["k1", "k2", "n_words", "n_features", "gain"])

    rows = found.select("k1", "k2", "n_words", "n_features", "ids").mapInArrow(run, "k1 long, k2 long, n_words long, n_features long, gain long")
    return rows.withColumn("real", F.lit(True))


def noise(id_col: Column, seed: int) -> Column:
    """A document's Gumbel noise times 1000, floored: from 32 bits of the sha256 of ``seed:id`` (null: the empty id)."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(code, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """A row per document: row_id, doc_id, n_words, n_features, weight. See ``resample``."""
    found = stage(segments(docs, text_col, max_words, buckets), "segments")
    goal = stage(segments(target, target_col, max_words, buckets), "target-segments")
    gain = gains(bucket_counts(found, buckets), bucket_counts(goal, buckets))

    split = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"), F.split(F.col(text_col), "\n").alias("lines"), *[k.alias(f"text_{i}") for i, k in enumerate(_text_keys(F.col(text_col)) if max_words > 1 else [])])
    split = split.select("*", F.posexplode_outer("lines").alias("pos", "line")).drop("lines")
    real = F.coalesce(F.rlike("line", F.lit(HAS_WORD)), F.lit(False))
    opens = F.coalesce("pos", F.lit(0)) == 0
    # A first line without words stands for its document; its key, of which there is no segment, is its own.
    k1, k2 = _keys(F.col("line"))
    lines = split.withColumn("real", real).where(opens | F.col("real"))
    places = lines.select("row_id", "doc_id", "real", F.when(F.col("real"), k1).otherwise(F.col("row_id")).alias("k1"), F.when(F.col("real"), k2).otherwise(F.lit(0)).alias("k2"))
    if max_words > 1:
        places = places.unionByName(lines.where(opens).select("row_id", "doc_id", F.lit(True).alias("real"), F.col("text_0").alias("k1"), F.col("text_1").alias("k2")))
    joined = places.join(_line_gains(found, gain), ["k1", "k2", "real"], "left")
    sums = joined.groupBy("row_id", "doc_id").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("n_words", "n_features", "gain")])
    weight = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features"))
    return sums.select("row_id", "doc_id", "n_words", "n_features", weight.cast("long").alias("weight"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its importance for the target, and the rank of those drawn: row_id, doc_id, n_words, n_features, weight, score, rank.

    Features are the runs of 1 to ``max_words`` words, hashed to ``buckets`` by crc32. Separator newlines cut the texts into lines; a
    distinct line's features are computed once, staged, and counted as often as it occurs; runs across lines are added for each
    distinct text. A bucket's gain is the floored 1000-fold logarithm of the target's share over the documents'; a document's weight is the
    floored mean gain of its features, its score adds Gumbel noise of its id. Of the N documents of ``min_words`` words or
    more, those of the percent * N // 100 highest scores are drawn and ranked from 1, ties to the smaller id; others have no rank.

    Scale: texts are shuffled once, as lines, combined before; then go a line's 128-bit key and its sums. Frequent lines meet a
    table of one row per line, which skewed joins split. The driver gets ``buckets`` counts and a count per range of the ranking.

    Null and empty texts have no features: weight 0, never drawn. Repeated rows and rows of one id are documents of their own; null ids
    come last among ties. Very long texts are handled line by line. An empty table gives no rows; an empty target has no features.
    Other columns are not looked at.
    """
    weighed = weigh(docs, target, id_col, text_col, target_col, max_words, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("fit", F.col("n_words") >= min_words)
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rows = ranks.placed(weighed, order, stage_path(weighed.sparkSession, "resampled"))
    drawn = rows.where("fit").count() * percent // 100
    rank = F.when(F.col("fit") & (F.col("rank") < drawn), F.col("rank") + 1)
    return ranks.ranked(rows).select("row_id", "doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn; rows of one id are drawn together. Texts are not shuffled where the ids drawn are few."""
    ids = resampled.where("rank IS NOT NULL").select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(F.col("drawn_id")), "left_semi")


#: The same in DuckDB, for runs of one word; crc32 is spelled out over the bytes of each distinct word.
SQL = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
texts AS (
  SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
placed AS (SELECT row_id, unnest(w) AS word FROM texts),
known AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT word FROM placed UNION SELECT word FROM goal)),
codes AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(hx) // 2), lambda i: CAST(concat('0x', substr(hx, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM known, crc_table),
s AS (SELECT bucket, count(*) AS s FROM placed JOIN codes USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN codes USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM placed) AS all_s, (SELECT count(*) FROM goal) AS all_t),
gain AS (
  SELECT b.bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM codes) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weighed AS (SELECT row_id, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM placed JOIN codes USING (word) JOIN gain USING (bucket) GROUP BY row_id),
scored AS (
  SELECT doc_id, row_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
         CAST(concat('0x', substr(sha256(concat('2024:', doc_id)), 1, 8)) AS BIGINT) AS h FROM texts LEFT JOIN weighed USING (row_id)),
ended AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score, n_features >= 20 AS fit FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id ASC NULLS LAST) AS place, sum(CASE WHEN fit THEN 1 ELSE 0 END) OVER () AS n FROM ended)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN fit AND place <= floor(10 * n / 100) THEN CAST(place AS BIGINT) END AS rank FROM ranked
"""
