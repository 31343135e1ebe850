"""Removal of bytes that long repeated strings cover, by suffix arrays over shards of anchored contexts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._runtime import stage
from mailquarry.llm._suffixes import permuted_prefixes, suffix_array
from mailquarry.llm._words import _power_tables, mixed

LENGTH = 400
#: Bytes of an anchor. Every string of LENGTH bytes holds one of its LENGTH - ANCHOR + 1 anchors whose hash is smallest there.
ANCHOR = 340
#: Contexts that one shard's suffix array takes.
SHARD_CONTEXTS = 6000
_AT_ONCE = 256


def _sliding(x: np.ndarray, width: int, pick: np.ufunc, pad: int) -> np.ndarray:
    """pick over all windows of ``width``, from running picks within blocks of that width in both directions."""
    blocks = np.full((-(-len(x) // width) + 1) * width, pad, x.dtype)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def anchors(raw: bytes, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Places and hashes of a text's anchors, and of each its context: bytes before and after the anchor, and a hash of the whole.

    A string of ``length`` bytes has the anchor whose hash is the smallest at its length - anchor + 1 starts, the first of equal ones; equal strings
    choose alike, as the choice depends on the string alone. An anchor's context is what the strings that choose it cover, so each string is in one context.
    """
    n, span = len(raw), length - anchor
    if n < length:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, np.zeros(0, np.int16), np.zeros(0, np.int16), none
    data = np.frombuffer(raw, np.uint8)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = mixed((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    least = _sliding(h, span + 1, np.minimum, 2**64 - 1)
    around = np.concatenate([np.zeros(span, np.uint64), least, np.zeros(span, np.uint64)])
    chosen = _sliding(around, span + 1, np.maximum, 0) == h
    at = np.flatnonzero(chosen)
    # By string: its first chosen place may be an earlier string's; then the next ones are tried.
    own = (np.cumsum(chosen) - chosen)[: len(least)]
    wrong = np.flatnonzero(h[at[own]] != least)
    while len(wrong):
        own[wrong] += 1
        wrong = wrong[h[at[own[wrong]]] != least[wrong]]
    low = np.flatnonzero(np.diff(own, prepend=-1))
    high = np.append(low[1:], len(own)) - 1 + length
    at = at[own[low]]
    context = mixed((sums[high] - sums[low]) * down[low] + mixed(((at - low) * 4096 + high - low).astype(np.uint64)))
    return at, h[at], (at - low).astype(np.int16), (high - at - anchor).astype(np.int16), context


def _raws(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    for at in range(0, batch.num_rows, _AT_ONCE):
        yield at, [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(column).slice(at, _AT_ONCE).to_pylist()]


def _anchored(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h, context, doc, pos, times, before, after): each distinct context of a text once, with how often the text has it."""
        seen: set[bytes] = set()
        for batch in batches:
            for start, raws in _raws(batch, 1):
                keys = batch.column(0).slice(start, len(raws)).to_pylist()
                parts: list[tuple] = []
                for key, raw in zip(keys, raws, strict=True):
                    digest = hashlib.blake2b(raw, digest_size=16).digest()
                    if len(raw) < length or digest in seen:  # exact copies are told by their number
                        continue
                    seen.add(digest)
                    at, h, before, after, context = anchors(raw, length, anchor)
                    context, first, times = np.unique(context, return_index=True, return_counts=True)
                    parts.append((h[first].view(np.int64), context.view(np.int64), np.full(len(first), key), at[first], np.minimum(times, 2), before[first], after[first]))
                if len(seen) > 500_000:
                    seen.clear()
                columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(7)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int8(), pa.int16(), pa.int16())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["h", "context", "doc", "pos", "times", "before", "after"])

    return run


def _cut_out(anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What stands before and after the anchor in each picked context: (h, context, times, left, right)."""
        for batch in batches:
            out: list[tuple] = []
            for start, raws in _raws(batch, 0):
                for raw, picks in zip(raws, batch.column(1).slice(start, len(raws)).to_pylist(), strict=True):
                    for p in picks:
                        at, end = p["pos"], p["pos"] + anchor
                        out.append((p["h"], p["context"], p["times"], raw[at - p["before"] : at], raw[end : end + p["after"]]))
            kinds = (pa.int64(), pa.int64(), pa.int8(), pa.binary(), pa.binary())
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["h", "context", "times", "left", "right"])

    return run


def _sorted_shard(length: int, anchor: int):
    span = length - anchor

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Spans (h, context, first, last; from the anchor on) of strings that the shard's suffix array finds more than once.

        Each context is its left bytes, one symbol for its anchor, and its right bytes; a string of ``length`` bytes is a window of span + 1 symbols
        there. Windows that share these symbols are neighbours in the array; they are repeated if their contexts stand in the texts twice in all, or oftener.
        """
        h, context, times = (rows[c].to_numpy() for c in ("h", "context", "times"))
        lefts, rights = rows["left"].to_pylist(), rows["right"].to_pylist()
        core = np.unique(h, return_inverse=True)[1] + 258
        n_left, n_right = np.fromiter(map(len, lefts), np.int64, len(h)), np.fromiter(map(len, rights), np.int64, len(h))
        ends = np.cumsum(n_left + n_right + 2) - 1
        starts = ends - n_left - n_right - 1
        raw = b"".join([a + b"\0" + b + b"\0" for a, b in zip(lefts, rights, strict=True)])
        s = np.append(np.frombuffer(raw, np.uint8).astype(np.int64) + 2, 0)
        s[starts + n_left] = core
        s[ends] = 1
        owner = np.repeat(np.arange(len(h) + 1), np.append(n_left + n_right + 2, 1))
        rest = np.append(ends, len(s) - 1)[owner] - np.arange(len(s))
        order = suffix_array(s)
        _, shared = permuted_prefixes(s, order, rest)
        # Windows in the array's order; a group goes on while the next suffix shares a whole window.
        window = rest > span
        group = np.cumsum(shared[order] <= span)
        weight = np.bincount(group, np.where(window, np.append(times, 0)[owner], 0)[order])
        at = np.sort(order[window[order] & (weight[group] > 1)])
        owner = owner[at]
        first = at - starts[owner] - n_left[owner]
        # Strings that start one after the other in a context are one span.
        fresh = np.diff(at, prepend=-2) != 1
        fresh[1:] |= owner[1:] != owner[:-1]
        begins = np.flatnonzero(fresh)
        stops = np.append(begins[1:], len(at)) - 1 if len(at) else begins
        found = owner[begins]
        return pa.table({"h": h[found], "context": context[found], "first": first[begins].astype(np.int32), "last": (first[stops] + length).astype(np.int32)})

    return run


def _windows(cut: DataFrame, span: int) -> DataFrame:
    """The strings of contexts: h, ahead (its bytes before the anchor), string (a hash of what it has before and after the anchor), context, times.

    Equal strings have equal anchors at equal places, so they meet by these three wherever their contexts differ.
    """
    before, after = F.octet_length("left"), F.octet_length("right")
    rows = cut.withColumn("ahead", F.explode(F.sequence(span - after, before)))
    head = F.substring("left", before - F.col("ahead") + 1, F.col("ahead"))
    tail = F.substring("right", F.lit(1), span - F.col("ahead"))
    return rows.select("h", "ahead", F.xxhash64(head, tail).alias("string"), "context", "times")


def _hot_strings(cut: DataFrame, length: int, anchor: int) -> DataFrame:
    """Spans as of a shard, of the contexts of hot anchors, by sums over their strings."""
    windows = _windows(stage(cut, "hot_contexts"), length - anchor)
    key = ["h", "ahead", "string"]
    again = stage(windows.groupBy(*key).agg(F.sum("times").alias("n")).where("n > 1").select(*key), "hot_strings")
    return windows.join(again, key).select("h", "context", (-F.col("ahead")).alias("first"), (length - F.col("ahead")).alias("last"))


def _runs(covered: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    for a, b in covered:
        np.add.at(edge, a, 1)
        np.add.at(edge, b, -1)
    inside = np.cumsum(edge[:-1]) > 0
    flips = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return flips[::2], flips[1::2]


def _looped(raw: bytes, loops: list[dict], length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans of contexts that a text has several times, at all their places."""
    at, _, _, _, context = anchors(raw, length, anchor)
    context = context.view(np.int64)
    by = np.argsort(context, kind="stable")
    sought, first, last = (np.array([x[c] for x in loops], np.int64) for c in ("context", "first", "last"))
    low, high = np.searchsorted(context[by], sought, "left"), np.searchsorted(context[by], sought, "right")
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    places = at[by[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]]]
    return places + first[which], places + last[which]


def _removed(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for start, raws in _raws(batch, 1):
                part = batch.slice(start, len(raws))
                ids, copied, firsts, lasts, loops = (part.column(i).to_pylist() for i in (0, 2, 3, 4, 5))
                for k, raw in enumerate(raws):
                    n, covered = len(raw), []
                    if copied[k] and n >= length:
                        covered.append((np.array([0]), np.array([n])))
                    elif firsts[k]:
                        covered.append((np.array(firsts[k], np.int64), np.array(lasts[k], np.int64)))
                        if loops[k]:
                            covered.append(_looped(raw, loops[k], length, anchor))
                    a, b = _runs(covered, n) if covered else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), n], strict=True))
                    out.append((ids[k], n, n - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """Whole texts without each byte that lies in a string of ``length`` bytes which also starts anywhere else.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes). Strings are judged on the input; matches do not cross documents.

    How: texts are cut into contexts around anchors, which equal strings choose alike, so that each string is in the context of one anchor. Of each distinct
    context of an anchor that stands anywhere twice, one row goes to the anchor's shard, with how often it stands there (contexts are told by 128 bits of hashes).
    There each is a short sequence with one symbol for the anchor; the shard gets a suffix array by induced sorting, and the prefixes that neighbours
    share tell which strings stand in two contexts, or in one that stands in the texts twice. What it finds is joined back to all places of the context. This
    decides every string but those of exact copies, which go whole. An anchor with more than ``shard_contexts`` contexts is too much for a shard: its contexts are split into their
    strings, which are counted by anchor, place of the anchor and a hash of the other bytes.

    Scale: anchors are a thirtieth of the bytes and travel as hashes; texts are shuffled twice, to cut out contexts and to remove
    what is found. Exact copies are told by digests and looked into once per task. Shards are as many as the contexts need and hold
    at most ``shard_contexts`` of one anchor; counts of the strings of other anchors are combined before their shuffle. Texts with such anchors are shuffled once more.
    A very long text is one row of each of these shuffles, with a span for at most each thirtieth byte or so.

    Null texts are empty, with n_bytes 0. Rows of equal text, repeated rows too, are copies of each other. Null ids are kept. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.xxhash64("doc_id", "text"))
    names = stage(rows.select("doc", F.md5("text").alias("digest")), "digests")
    copies = stage(names.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "copies")
    copied = names.join(copies, "digest").select("doc").distinct()

    # Right sides of joins with hot anchors or contexts are staged and have few rows per key, which leaves Spark free to split the left sides.
    schema = "h long, context long, doc long, pos int, times byte, before short, after short"
    found = stage(rows.select("doc", "text").mapInArrow(_anchored(length, anchor), schema), "occurrences")
    again = stage(found.groupBy("h").agg(F.sum("times").alias("n")).where("n > 1").select("h"), "anchors")
    known = stage(found.join(again, "h"), "known")
    contexts = known.groupBy("h", "context").agg(F.least(F.sum("times"), F.lit(2)).cast("byte").alias("times"), F.min(F.struct("doc", "pos", "before", "after")).alias("at"))
    contexts = stage(contexts.select("h", "context", "times", "at.*"), "contexts")
    hot = stage(contexts.groupBy("h").agg(F.count("*").alias("contexts")).where(F.col("contexts") > shard_contexts), "hot_anchors")
    n_hot = hot.agg(F.sum("contexts")).head()[0] or 0

    def cut_out(some: DataFrame) -> DataFrame:
        picks = some.groupBy("doc").agg(F.collect_list(F.struct("h", "context", "times", "pos", "before", "after")).alias("picks"))
        texts = rows.select("doc", "text").join(picks, "doc").dropDuplicates(["doc"])
        return texts.select("text", "picks").mapInArrow(_cut_out(anchor), "h long, context long, times byte, left binary, right binary")

    shards = max(1, -(-(contexts.count() - n_hot) // shard_contexts))
    # Shards are small in bytes but not in work, so their number of partitions is given.
    cut = cut_out(contexts.join(hot, "h", "left_anti") if n_hot else contexts)
    sharded = cut.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).repartition(shards, "shard")
    spans = sharded.groupBy("shard").applyInArrow(_sorted_shard(length, anchor), "h long, context long, first int, last int")
    if n_hot:
        spans = spans.unionByName(_hot_strings(cut_out(contexts.join(hot, "h", "left_semi")), length, anchor))
    placed = known.join(stage(spans, "strings"), ["h", "context"])
    looped = F.when(F.col("times") > 1, F.struct("context", "first", "last")).alias("loop")
    placed = placed.select("doc", (F.col("pos") + F.col("first")).alias("first"), (F.col("pos") + F.col("last")).alias("last"), looped)
    places = placed.groupBy("doc").agg(*[F.collect_list(c).alias(c + "s") for c in ("first", "last", "loop")])
    facts = stage(copied.withColumn("copied", F.lit(True)).join(places, "doc", "full"), "facts")
    joined = rows.join(facts, "doc", "left").select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "firsts", "lasts", "loops")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_removed(length, anchor), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
