"""Small document tables with every awkward case, and plain definitions of what operators return."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, cls string"


def sentence(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 8)))) for _ in range(n))


def texts() -> list[str | None]:
    base, passage = sentence(1, 130), sentence(2, 120)
    near = base.split()
    near[40] = "changed"
    return [
        base, base, " ".join(near), " ".join(near[:-3]), None, "", " \n\t ", "one two", "ONE two", "a b c d e", "A b\tc  d e",
        passage + "\n" + sentence(3, 60), sentence(4, 50) + "\n" + passage, "x " * 600, "the end. " * 200, sentence(5, 4000),
        "Line of order 17 shipped\n" + sentence(6, 9), "Line of order 99 shipped\n" + sentence(7, 9), "Line of order 3 shipped\nLine of order 4 shipped",
        "Line of order 5 shipped", "Line of order 6 shipped", "é" * 500, "mail bob@example.com or +1 (234) 555-0100, 4111 1111 1111 1111 at 10.0.0.1",
    ]


def documents(spark, rows=None):
    """Documents with null ids, repeated rows and columns whose names operators use themselves."""
    if rows is None:
        found = [(i, t) for i, t in enumerate(texts())]
        rows = [*found, (0, texts()[0]), (7, "another text of id seven"), (None, "no id"), (None, None)]
    return spark.createDataFrame([(i, t, "en", [None, "a", "b", "ä"][k % 4], 0, -1, -1.0, "x") for k, (i, t) in enumerate(rows)], SCHEMA)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def components(n: int, linked) -> list[int]:
    """The smallest index that links reach from each."""
    label = list(range(n))
    for _ in range(n):
        fresh = [min([label[i], *(label[j] for j in range(n) if linked[i][j])]) for i in range(n)]
        if fresh == label:
            return label
        label = fresh
    return label


def repeated(raws: list[bytes], length: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, sha256 of the rest) by looking at every string."""
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                covered[i : i + length] = True
        edges = np.diff(covered.astype(int), prepend=0, append=0)
        out.append((len(r), int(covered.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~covered])).hexdigest()))
    return out
