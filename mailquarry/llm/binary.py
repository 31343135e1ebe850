"""Token ids as fixed-width bit-packed blocks: writer, reader and random access."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mailquarry.llm._runtime import stage
from mailquarry.llm._tokens import encoder, largest_id

#: Ids after which a block is closed. A document lies in one block.
BLOCK_IDS = 65_536
FORMAT = "shard int, block int, bits int, n_ids long, n_docs long, doc_ids array<{id}>, ends array<long>, payload binary"


def bits_for(vocabulary: int) -> int:
    """The least width that holds every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest bit first, padded to a whole byte. An id that needs more bits is an error."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} needs more than {bits} bits")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    planes = (ids[:, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids from ``start`` to ``stop`` of a block; only the bytes that hold them are touched."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", stop - start, 2 * start).astype(np.uint32)
    first = start * bits // 8
    raw = np.frombuffer(payload, np.uint8, -(-stop * bits // 8) - first, first)
    flat = np.unpackbits(raw, bitorder="little")[start * bits - 8 * first :][: (stop - start) * bits]
    return flat.reshape(stop - start, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def _blocks(path: str, end_id: int, bits: int, block_ids: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, block = encoder(path, keep_space=True), TaskContext.get().partitionId(), 0
        keys: list = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            ids, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts]).tolist()
            row = {"shard": shard, "block": block, "bits": bits, "n_ids": len(ids), "n_docs": len(keys), "doc_ids": list(keys), "ends": ends, "payload": pack_bits(ids, bits)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for key, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    keys.append(key)
                    parts.append(np.append(ids, np.uint32(end_id)))
                    held += len(ids) + 1
                    if held >= block_ids:
                        yield close()
                        keys, parts, held, block = [], [], 0, block + 1
        if keys:
            yield close()

    return run


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending id order.

    The file format: a row per block of about ``block_ids`` ids, in Parquet, so that any store works and
    Spark commits whole files only. ``payload`` holds the ids at the fixed width ``bits`` of the
    vocabulary, lowest bit first; ``doc_ids`` and ``ends`` say which documents lie in it and where each ends,
    which makes each block readable by itself: document j has bits ``ends[j-1] * bits`` to
    ``ends[j] * bits``. ``shard`` and ``block`` give the order. ``vocabulary`` is one more than the largest id; if not
    given, the tokenizer tells.

    Scale: one range shuffle of (id, text); each range is one shard, encoded in a stream that holds one
    block. Null ids come first; rows of equal ids are ordered by a hash of their text, so they too can go to several ranges. A null text is empty.
    """
    if vocabulary is None:
        vocabulary = largest_id(tokenizer) + 1
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("twin", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "twin").sortWithinPartitions("doc_id", "twin", "text").select("doc_id", "text")
    form = FORMAT.format(id=kind)
    schema = to_arrow_schema(StructType.fromDDL(form))
    ordered.mapInArrow(_blocks(tokenizer, end_id, bits_for(max(vocabulary, end_id + 1)), block_ids, schema), form).write.parquet(path)


def read_ids(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The blocks of a written path."""
    return spark.read.schema(FORMAT.format(id=id_type)).parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, block_start): the number of ids before each block.

    Sums of shards are added up first, then blocks within their shard, so no task sees more than the list
    of shards or the blocks of one shard.
    """
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.select("shard", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner_start"))
    return inner.join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("inner_start")).alias("block_start"))


def document_ids(spark: SparkSession, path: str, doc_ids: list[int], id_type: str = "bigint") -> dict[int, list[list[int]]]:
    """Random access: the ids of a few documents; other blocks' payloads are not read."""
    hit = read_ids(spark, path, id_type).where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, doc_ids))))
    found: dict[int, list[list[int]]] = {}
    for row in hit.toLocalIterator():
        for j, key in enumerate(row.doc_ids):
            if key in doc_ids:
                found.setdefault(key, []).append(unpack_bits(row.payload, row.bits, row.ends[j - 1] if j else 0, row.ends[j]).tolist())
    return found


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, ends, bits, payload, shard, block = (batch.column(n)[i].as_py() for n in ("doc_ids", "ends", "bits", "payload", "shard", "block"))
            starts = [0, *ends[:-1]]
            ids = unpack_bits(payload, bits, 0, ends[-1]).astype("<u4")
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(doc_ids, batch.schema.field("doc_ids").type.value_type), pa.array(starts, pa.int64()), pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(crcs, pa.int64())],
                ["shard", "block", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def index(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Per document of a written path, from the unpacked payloads: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it. Empty paths give no rows.
    """
    blocks = read_ids(spark, path, id_type)
    starts = stage(block_starts(blocks), "block_starts")
    docs = blocks.mapInArrow(_digests, f"shard int, block int, doc_id {id_type}, inner long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["shard", "block"]).select("doc_id", (F.col("block_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
