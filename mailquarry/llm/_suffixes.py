"""Suffix arrays by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x100000001B3)
#: Mean suffixes of a block of buckets from which numpy induces.
_BLOCK = 64


def _smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them. Runs of one symbol have the type of the run's end."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    ends = np.append(differs, n - 1)
    smaller = np.zeros(n, bool)
    smaller[differs] = s[differs] < s[differs + 1]
    smaller[n - 1] = True  # the sentinel
    return np.repeat(smaller[ends], np.diff(ends, prepend=-1))


def _induced(s: list[int], smaller: list[bool], heads: np.ndarray, tails: np.ndarray, seeds: list[int]) -> list[int]:
    """All suffixes in order, induced from the leftmost-smaller ones in the order given."""
    order = [-1] * len(s)
    at = tails.tolist()
    for i in reversed(seeds):
        at[s[i]] -= 1
        order[at[s[i]]] = i
    at = heads.tolist()
    for i in order:  # grows while it is read: larger suffixes, left to right
        if i > 0 and not smaller[i - 1]:
            c = s[i - 1]
            order[at[c]] = i - 1
            at[c] += 1
    at = tails.tolist()
    for k in range(len(order) - 1, -1, -1):  # smaller suffixes, right to left
        i = order[k]
        if i > 0 and smaller[i - 1]:
            c = s[i - 1]
            at[c] -= 1
            order[at[c]] = i - 1
    return order


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol, each one's rank in its group there, and the groups' symbols and sizes."""
    by = np.argsort(symbols, kind="stable")
    found = symbols[by]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    sizes = np.diff(np.append(first, len(found)))
    return by, np.arange(len(found)) - np.repeat(first, sizes), found[first], sizes


def _blocks(s: np.ndarray, n_symbols: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of symbols of which no two, or one twice, stand side by side; symbols that follow themselves are alone."""
    least = np.full(n_symbols, -1, np.int64)  # by symbol: the largest one, itself at most, that it stands beside
    np.maximum.at(least, np.maximum(s[1:], s[:-1]), np.minimum(s[1:], s[:-1]))
    blocks, first = [], 0
    for c, x in enumerate(least.tolist()):
        if x >= first:
            blocks.append((first, c - 1))
            first = c
        if x == c:
            blocks.append((c, c))
            first = c + 1
    blocks.append((first, n_symbols - 1))
    return [(a, b) for a, b in blocks if a <= b]


def _induced_in_blocks(s: np.ndarray, smaller: np.ndarray, heads: np.ndarray, tails: np.ndarray, seeds: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """As ``_induced``, a block of buckets at a time: suffixes of a block induce none in it, but where a symbol follows itself."""
    order = np.full(len(s), -1, np.int64)
    by, rank, symbols, sizes = _grouped(s[seeds])
    n_seeds = np.zeros(len(heads), np.int64)
    n_seeds[symbols] = sizes
    order[np.repeat(tails[symbols] - sizes, sizes) + rank] = seeds[by]
    itself = np.zeros(len(heads), bool)
    itself[s[1:][s[1:] == s[:-1]]] = True
    walk = [(a, b, bool(itself[a])) for a, b in blocks]

    def induce(found: np.ndarray, at: np.ndarray, kind: bool, step: int) -> None:
        found = found[found > 0] - 1
        found = found[smaller[found] == kind]
        if len(found):
            by, rank, symbols, sizes = _grouped(s[found])
            order[np.repeat(at[symbols] - (step < 0), sizes) + step * rank] = found[by]
            at[symbols] += step * sizes

    at = heads.copy()
    for a, b, rounds in walk:  # larger suffixes, left to right
        if not rounds:
            induce(order[heads[a] : tails[b]], at, False, 1)
            continue
        done = int(heads[a])
        while done < at[a]:
            part, done = order[done : at[a]], int(at[a])
            induce(part, at, False, 1)
        induce(order[tails[a] - n_seeds[a] : tails[a]], at, False, 1)
    larger, at = at, tails.copy()
    for a, b, rounds in reversed(walk):  # smaller suffixes, right to left
        if not rounds:
            induce(order[heads[a] : tails[b]][::-1], at, True, -1)
            continue
        done = int(tails[a])
        while done > at[a]:
            part, done = order[at[a] : done][::-1], int(at[a])
            induce(part, at, True, -1)
        induce(order[heads[a] : larger[a]][::-1], at, True, -1)
    return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of symbols 0 and up, of which the last is the only 0."""
    if len(s) < 3:
        return np.arange(len(s) - 1, -1, -1)
    smaller = _smaller_than_next(s)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(s)
    tails = np.cumsum(sizes)
    blocks = _blocks(s, len(sizes))

    def induced(seeds: np.ndarray) -> np.ndarray:
        if len(blocks) * _BLOCK < len(s):
            return _induced_in_blocks(s, smaller, tails - sizes, tails, seeds, blocks)
        return np.array(_induced(s.tolist(), smaller.tolist(), tails - sizes, tails, seeds.tolist()))

    order = induced(leftmost)
    is_leftmost = np.zeros(len(s), bool)
    is_leftmost[leftmost] = True
    ordered = order[is_leftmost[order]]

    # Equal leftmost-smaller substrings get equal names; a substring goes up to the next one's start.
    up = np.cumprod(np.full(len(s) + 1, _STEP, np.uint64), dtype=np.uint64)
    spread = (s.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((spread ^ (spread >> np.uint64(31))) * up[:-1], dtype=np.uint64)])
    place = np.searchsorted(leftmost, ordered)
    ends = np.append(leftmost[1:] + 1, len(s))[place]
    lengths = ends - ordered
    # Hashes of equal substrings differ by a power only; they are brought to the same one.
    codes = (sums[ends] - sums[ordered]) * up[len(s) - ordered]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = (lengths[1:] != lengths[:-1]) | (codes[1:] != codes[:-1])
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 < len(ordered):
        reduced = np.empty(len(ordered), np.int64)
        reduced[place] = names
        ordered = leftmost[suffix_array(reduced)]
    return induced(ordered)


def permuted_prefixes(s: np.ndarray, order: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, by its place in the text: the one before it in the array (-1: none), and how many symbols they share.

    rest: symbols from each place to the end of its sequence; shared prefixes end there.
    Where a suffix and the one before it in the array follow equal symbols, their shared prefix is that of the place before, less one. Only the others are compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    carried = np.zeros(n, bool)
    carried[1:] = (before[1:] > 0) & (s[:-1] == s[before[1:] - 1]) & (rest[:-1] == rest[1:] + 1)
    shared = np.zeros(n, np.int64)
    open_ones = np.flatnonzero(~carried & (before >= 0) & (rest > 0))
    k = 0
    while len(open_ones):
        other = before[open_ones] + k
        open_ones = open_ones[(other < n) & (s[open_ones + k] == s[np.minimum(other, n - 1)])]
        k += 1
        shared[open_ones] = k
        open_ones = open_ones[rest[open_ones] > k]
    last = np.maximum.accumulate(np.where(carried, 0, np.arange(n)))
    return before, shared[last] - (np.arange(n) - last)
