"""Fill-in-middle transformation: texts cut into prefix, middle and suffix by units, in a pyarrow.compute pipeline."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailquarry.llm._runtime import spare

#: What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Percent of the texts that stay as they are, and of the others that open with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Bytes of text whose units are in memory at once; a longer text is taken in parts.
CHUNK = 1 << 20
PREFIX, MIDDLE, SUFFIX = range(3)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True


def draw(id_col: Column, seed: int, k: int) -> Column:
    """The k-th (from 0) 32-bit number drawn for a document: 8 hex digits of the sha256 of ``seed:id``. A null id counts as empty."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(code, 8 * k + 1, 8), 16, 10).cast("long")


def form_of(text: Column, plain_draw: Column, spm_draw: Column, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, marks: Sequence[str] = MARKS) -> Column:
    """plain for a text that is null, empty, drawn to stay or holds a mark; else spm or psm."""
    marked = F.contains(text, F.lit(marks[0]))
    for mark in marks[1:]:
        marked = marked | F.contains(text, F.lit(mark))
    stays = text.isNull() | (text == "") | marked | (plain_draw % 100 >= 100 - plain_percent)
    return F.when(stays, "plain").when(spm_draw % 100 < spm_percent, "spm").otherwise("psm")


def _starts(data: np.ndarray, unit: str) -> np.ndarray:
    """Whether a unit begins at each byte of one text: a code point, a line with its break, or a word with the white space after it."""
    if unit == "char":
        return (data & 0xC0) != 0x80
    begins = np.zeros(len(data), bool)
    if unit == "line":
        begins[1:] = data[:-1] == 10
    else:
        white = _WHITE[data]
        begins[1:] = white[:-1] & ~white[1:]
    begins[:1] = True
    return begins


def _parts(raw: bytes, starts: np.ndarray, chunk: int) -> Iterator[tuple[int, int, int]]:
    """(from byte, to byte, units before) of the parts of a text, each of about ``chunk`` bytes and of whole units."""
    at = units = 0
    while at < len(raw):
        end = len(raw)
        if end - at > chunk:
            later = np.flatnonzero(starts[at + chunk : at + 2 * chunk])
            if not len(later):
                later = np.flatnonzero(starts[at + chunk :])
            end = at + chunk + int(later[0]) if len(later) else end
        yield at, end, units
        units += int(np.count_nonzero(starts[at:end]))
        at = end


def _unit_lists(raws: list[bytes], starts: list[np.ndarray]) -> pa.ListArray:
    """The units of each text as lists of strings over one buffer."""
    data = b"".join(raws)
    begins = np.flatnonzero(np.concatenate(starts))
    offsets = np.append(begins, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data))
    counts = np.fromiter(map(np.count_nonzero, starts), np.int64, len(starts))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), units)


def _pieces(lists: pa.ListArray, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each list: its units whose ordinal is below low, below high, and the rest. base: ordinal of a list's first unit."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = pc.subtract(pa.array(base), pc.cast(lists.offsets[:-1], pa.int64()))
    ordinal = pc.add(pa.array(np.arange(len(flat))), pc.take(first, parent))
    in_prefix, below_high = pc.less(ordinal, pc.take(pa.array(low), parent)), pc.less(ordinal, pc.take(pa.array(high), parent))
    out = []
    for role in (in_prefix, pc.and_not(below_high, in_prefix), pc.invert(below_high)):
        owners = pc.filter(parent, role).to_numpy()
        offsets = np.searchsorted(owners, np.arange(len(lists) + 1)).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pc.filter(flat, role)), ""))
    return out


def cut(texts: pa.Array, draws: tuple[np.ndarray, np.ndarray], unit: str = "char", chunk: int = CHUNK) -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray]:
    """Prefixes, middles and suffixes of texts, with their numbers of units n, and the units before the middle and before the suffix.

    The prefix ends after the smaller of draw % (n + 1), the middle after the larger.
    """
    raws = [x.encode() for x in texts.to_pylist()]
    starts = [_starts(np.frombuffer(r, np.uint8), unit) for r in raws]
    n = np.fromiter(map(np.count_nonzero, starts), np.int64, len(raws))
    a, b = (np.asarray(d, np.int64) % (n + 1) for d in draws)
    low, high = np.minimum(a, b), np.maximum(a, b)
    done: list[list[pa.Array]] = [[], [], []]
    owners: list[int] = []
    held: list[tuple[int, int, int, int]] = []

    def finish() -> None:
        own = np.array([d for d, *_ in held])
        lists = _unit_lists([raws[d][s:e] for d, s, e, _ in held], [starts[d][s:e] for d, s, e, _ in held])
        for pieces, found in zip(done, _pieces(lists, np.array([u for *_, u in held]), low[own], high[own]), strict=True):
            pieces.append(pc.cast(found, pa.large_string()))
        owners.extend(own.tolist())
        held.clear()

    size = 0
    for d, raw in enumerate(raws):
        for s, e, u in _parts(raw, starts[d], chunk):
            if held and size + e - s > chunk:
                finish()
                size = 0
            held.append((d, s, e, u))
            size += e - s
    if held:
        finish()
    offsets = pa.array(np.searchsorted(owners, np.arange(len(raws) + 1)).astype(np.int64))
    whole = [pc.binary_join(pa.LargeListArray.from_arrays(offsets, pa.concat_arrays([pa.array([], pa.large_string()), *x])), pa.scalar("", pa.large_string())) for x in done]
    return whole, n, low, high


def assembled(pieces: list[pa.Array], spm: pa.Array, marks: Sequence[str] = MARKS) -> pa.Array:
    """The marked text: prefix, suffix, middle; or suffix, prefix, middle where spm."""
    p, s, m = (pa.scalar(x, pa.large_string()) for x in marks)
    none = pa.scalar("", pa.large_string())
    psm = pc.binary_join_element_wise(p, pieces[PREFIX], s, pieces[SUFFIX], m, pieces[MIDDLE], none)
    return pc.if_else(spm, pc.binary_join_element_wise(s, pieces[SUFFIX], p, pieces[PREFIX], m, pieces[MIDDLE], none), psm)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    unit: str = "char",
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    marks: Sequence[str] = MARKS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``docs`` with columns n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points, null if plain) and output.

    Four 32-bit numbers drawn from a hash of seed and id decide: the first two where the text is cut, the third whether it
    stays as it is, the fourth its order. In each batch the texts become list arrays of units (``char``: code points, ``line``:
    lines with their breaks, ``word``: words with the white space after them); these are flattened with their parents' indices,
    numbered, filtered by role and joined again. Columns that have one of the new names are replaced.

    Scale: no shuffle; forms are decided in the JVM, and the units of ``chunk`` bytes are in memory at once: very long texts are
    taken in parts. Reruns agree.

    Null text: n 0, plain, output empty. Null ids draw as the empty id. Repeated rows and rows of one id get the same draws. An
    empty table gives no rows.
    """
    if unit not in ("char", "line", "word"):
        raise ValueError(f"no such unit: {unit}")
    if text_col in ("n", "form", "prefix_chars", "middle_chars", "output"):
        raise ValueError(f"the text may not stand in {text_col}, which is replaced")
    if len({*marks}) != 3 or not all(marks) or any(a != b and a in b for a in marks for b in marks):
        raise ValueError("three marks are needed, none part of another")
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kept = [c for c in docs.columns if c not in names]
    first, second, form = spare(docs, "fim_first", "fim_second", "fim_form")
    numbers = [draw(F.col(id_col), seed, k) for k in range(4)]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], numbers[0].alias(first), numbers[1].alias(second), form_of(F.col(text_col), numbers[2], numbers[3], plain_percent, spm_percent, marks).alias(form))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.StringType() if c in ("form", "output") else T.LongType()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, forms = pc.cast(pc.fill_null(batch.column(text_col), ""), pa.large_string()), batch.column(form)
            open_rows = pc.not_equal(forms, "plain")
            draws = tuple(pc.filter(batch.column(c), open_rows).to_numpy() for c in (first, second))
            pieces, units, _, _ = cut(pc.filter(texts, open_rows), draws, unit, chunk)
            out = assembled(pieces, pc.equal(pc.filter(forms, open_rows), "spm"), marks)
            length = lambda role: pc.replace_with_mask(pa.nulls(len(texts), pa.int64()), open_rows, pc.cast(pc.utf8_length(pieces[role]), pa.int64()))
            if unit == "char":
                n = pc.cast(pc.utf8_length(texts), pa.int64())
            else:
                n = np.array([np.count_nonzero(_starts(np.frombuffer(x.encode(), np.uint8), unit)) for x in texts.to_pylist()], np.int64)
                n = pa.array(n)
            columns = [n, forms, length(PREFIX), length(MIDDLE), pc.cast(pc.replace_with_mask(texts, open_rows, out), pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + columns, [*kept, *names])

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made of, from output and form alone."""
    parted = F.array(F.split(output, "|".join(map(re.escape, marks)), -1))  # once, although its items are used again and again
    psm = F.get(F.transform(parted, lambda x: F.concat(x[1], x[3], x[2])), 0)
    spm = F.get(F.transform(parted, lambda x: F.concat(x[2], x[3], x[1])), 0)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(done: DataFrame, id_col: str = "doc_id", marks: Sequence[str] = MARKS) -> DataFrame:
    """A row per document of ``fill_in_middle``: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    code = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select(F.col(id_col).alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", code(F.col("output")).alias("output_sha256"), code(restored(F.col("output"), F.col("form"), marks)).alias("restored_sha256"))


#: The digests in DuckDB.
SQL = """
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, n, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) % (n + 1) AS a, CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) % (n + 1) AS b,
         CAST(concat('0x', substr(h, 17, 8)) AS BIGINT) % 100 AS c, CAST(concat('0x', substr(h, 25, 8)) AS BIGINT) % 100 AS d FROM drawn),
cuts AS (
  SELECT *, least(a, b) AS low, greatest(a, b) AS high,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
pieces AS (SELECT *, substr(t, 1, low) AS p, substr(t, low + 1, high - low) AS m, substr(t, high + 1) AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(low AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(high - low AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(t) AS restored_sha256
FROM pieces
"""
