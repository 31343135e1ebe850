"""Hashes of words and of runs of words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)
_BACK = np.uint64(pow(0x100000001B3, -1, 1 << 64))
#: Bytes of text hashed together.
CHUNK = 1 << 19
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            table = np.full(max(n, CHUNK + (1 << 16)), base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts' UTF-8 bytes in lists of about CHUNK bytes."""
    part: list[bytes] = []
    held = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if part and held + len(raw) > CHUNK:
            yield part
            part, held = [], 0
        part.append(raw)
        held += len(raw) + 1
    if part:
        yield part


class Runs(NamedTuple):
    """All texts' bytes in one array, a line break after each; where runs start and end there; their hashes; the number of runs of each text; hashes of the runs' heads."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    heads: list[np.ndarray]


def run_hashes(raws: list[bytes], letters: np.ndarray, heads: Sequence[int] = ()) -> Runs:
    """Runs of ``letters`` in many texts at once, A-Z hashed in lower case. heads: so many first bytes are hashed too, each number apart; of shorter runs they mean nothing."""
    data = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
    lengths = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    edges = np.flatnonzero(np.diff(letters[data], prepend=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)
    of_heads = [mixed((sums[np.minimum(starts + k, len(data))] - sums[starts]) * down[starts] + np.uint64(1_000_003 * k)) for k in heads]
    return Runs(data, starts, ends, h, np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0), of_heads)


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased (A-Z) words, and the number of words of each text."""
    found = run_hashes(raws, ~SPACES)
    return found.hashes, found.counts


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words; of fewer words, the whole as one; of none, nothing."""
    for raws in chunks(texts):
        h, counts = word_hashes(raws)
        run = h.copy()
        for k in range(1, words):
            run[:-k] = run[:-k] * _ODD + h[k:]
        run = mixed(run)
        at = 0
        for n in counts.tolist():
            if n >= words:
                yield np.unique(run[at : at + n - words + 1])
            elif n:
                code = np.uint64(n)
                for x in h[at : at + n]:
                    code = mixed((np.array([code]) * _ODD + x))[0]
                yield np.array([code], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
            at += n
