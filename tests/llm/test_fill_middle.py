"""Fill-in-middle against a plain definition, with awkward tables, units and very long texts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailquarry.llm import fill_middle
from tests.llm import helpers as H

UNITS = {"char": lambda t: list(t), "line": lambda t: re.findall(r"[^\n]*\n|[^\n]+\Z", t), "word": lambda t: re.findall(r"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|\A[\x20\x09-\x0D]+\Z", t)}


def units_of(text, unit):
    if unit != "word":
        return UNITS[unit](text)
    found, begin = [], 0
    for k in range(1, len(text)):
        if text[k - 1] in " \t\n\v\f\r" and text[k] not in " \t\n\v\f\r":
            found.append(text[begin:k])
            begin = k
    return [*found, text[begin:]] if text else []


def plain_definition(key, text, unit="char", seed=1, plain=10, spm=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    code = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(code[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = units_of(text, unit)
    n = len(units)
    if not text or any(m in text for m in marks) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


def rows():
    texts = [*H.texts(), "a<P>b", "no mark <", "<S", "<M>", "\n\n", "é\nü\n", "\U0001f600" * 40, " lead", "tail \n "]
    found = [(i, t) for i, t in enumerate(texts * 3)]
    return [*found, (0, texts[0]), (7, "another text of id seven"), (None, "no id"), (None, None), (3, "")]


@pytest.mark.parametrize(("unit", "chunk"), [("char", 1 << 20), ("char", 64), ("line", 100), ("word", 100)])
def test_equals_the_definition(spark, unit, chunk):
    docs = H.documents(spark, rows()).withColumn("form", F.lit("own")).repartition(3)
    done = fill_middle.fill_in_middle(docs, unit=unit, chunk=chunk)
    assert set(done.columns) == {*docs.columns, "n", "form", "prefix_chars", "middle_chars", "output"}
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in done.collect())
    assert got == Counter((i, *plain_definition(i, t, unit)) for i, t in rows())
    assert {r.form for r in done.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    back = done.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in rows())


def test_digests_and_other_parameters(spark):
    docs = H.documents(spark, rows())
    marks = ("[pre]", "[suf]", "[mid]")
    done = fill_middle.fill_in_middle(docs, seed=9, plain_percent=0, spm_percent=50, marks=marks)
    got = {(r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in fill_middle.digests(done, marks=marks).collect()}
    want = {(i, *plain_definition(i, t, "char", 9, 0, 50, marks)[1::3], t) for i, t in rows()}
    code = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    assert got == {(i, form, code(out), code(t)) for i, form, out, t in want}
    for wrong in (("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs, marks=wrong)
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(docs, unit="page")


def test_empty_table(spark):
    assert fill_middle.digests(fill_middle.fill_in_middle(H.documents(spark, []))).count() == 0


def test_a_very_long_text_is_taken_in_parts():
    text = "aé\u4e16\U0001f600\n" * 600_000
    pieces, n, low, high = fill_middle.cut(pa.array([text, "b"], pa.large_string()), (np.array([2_500_001, 0]), np.array([7, 1])))
    assert n.tolist() == [3_000_000, 1] and (low[0], high[0]) == (7, 2_500_001)
    p, m, s = (x.to_pylist() for x in pieces)
    assert p[0] == text[:7] and m[0] == text[7:2_500_001] and s[0] == text[2_500_001:] and (p[1], m[1], s[1]) == ("", "b", "")
