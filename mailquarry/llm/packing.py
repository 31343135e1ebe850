"""Best-fit packing of documents into token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._runtime import stage
from mailquarry.llm._tokens import encoder

SEQUENCE_TOKENS = 4096
#: Pieces that one task packs together: enough for the rule to find good fits, few enough for a second's work.
GROUP_PIECES = 6000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and offsets of items placed one by one by the sum-of-squares rule.

    With N(g) open bins of residual gap g (above 0), an item goes into the open bin, of those that it fits, that makes
    the sum of N(g)^2 over all gaps smallest; ties go to the tightest fit. All lengths are known
    ahead, so the items come longest first, and a new bin is opened only if none fits.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    never = np.iinfo(np.int64).max
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        taken = counts[n:capacity]  # by the gap left after it
        # Growth of the sum: 2 (N(left) - N(gap)) + 2; full bins count no more, so there 1 - 2 N(gap).
        growth = np.where(taken > 0, 2 * (counts[: capacity - n] - taken) + 2, never)
        if n < capacity and taken[0]:
            growth[0] = 1 - 2 * taken[0]
        left = int(np.argmin(growth)) if n < capacity else 0
        if n < capacity and growth[left] < never:
            bins[i] = stacks[left + n].pop()
            counts[left + n] -= 1
        else:
            left = capacity - n
            bins[i], made = made, made + 1
        offsets[i] = capacity - n - left
        if left:
            stacks[left].append(int(bins[i]))
            counts[left] += 1
    return bins, offsets


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, keep_space=False)
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            for at in range(0, len(ids), 64):
                for key, found in zip(ids[at : at + 64], encode(texts.slice(at, 64).to_pylist()), strict=True):
                    found = np.append(found, np.uint32(end_id))
                    for k, start in enumerate(range(0, len(found), capacity)):
                        piece = found[start : start + capacity]
                        out.append((key, k, start, len(piece), zlib.crc32(piece.astype("<u4").tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 5, (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacity: int = SEQUENCE_TOKENS,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pack documents into as few sequences of at most ``capacity`` tokens as sum-of-squares packing can.

    A document is its text's ids and ``end_id``. Only longer documents are cut, into pieces of ``capacity``
    tokens and a last one of what is left. Returns a row per piece: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset; sequences have no gaps.

    Scale: the text is read and encoded once, where it lies. Only the pieces' lengths are staged and
    shuffled. Full pieces are sequences of their own; the others go by a hash to groups of about
    ``group_pieces``, as many as the input needs, and each group is packed in one task. What a group's
    open bins waste is a fixed number of sequences in thousands.

    Null or empty texts become a document of the end id alone. Repeated rows are documents of
    their own, even if they share an id; null ids are kept. An empty table gives no rows. Other columns are
    not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stage(rows.mapInArrow(_pieces(tokenizer, end_id, capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"), "pieces")
    open_ones, whole = pieces.where(F.col("length") < capacity), pieces.where(F.col("length") == capacity)
    groups = max(1, -(-open_ones.count() // group_pieces))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(key: tuple, part: pa.Table) -> pa.Table:
        part = part.drop_columns("grp").sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        bins, offsets = sum_of_squares(part["length"].to_numpy(), capacity)
        part = part.append_column("sequence_id", pa.array(bins * groups + key[0].as_py()))
        return part.append_column("offset", pa.array(offsets))

    # A row's place in the staged table decides its group: even groups, whatever ids or texts repeat.
    grp = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("grp")
    packed = open_ones.select("*", grp).groupBy("grp").applyInArrow(place, schema)
    numbered = whole.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(numbered)
