"""Token ids of whole texts by the ``tokenizers`` library, with a cache of the pieces between white space."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable

import numpy as np

#: White space to one of Python's and the tokenizers' regex engines but not the other: such texts go whole to the library.
_ODD = re.compile("[\x01\x1c-\x1f\x85᠎​﻿]")
#: White space other than a space or a line break.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CHUNK = re.compile(r"\s*\S+|\s+")
#: Pieces that a worker's cache holds: words alone, and words with the white space before them.
_CACHE_PIECES = {False: 400_000, True: 1_000_000}
#: Characters that they hold in all, and of one piece that is to stay.
_CACHE_CHARS, _LASTING_CHARS = 40_000_000, 200
_AT_ONCE = 2_000
#: The characters that stand for bytes in byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 and up.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_encoders: dict[tuple[str, bool], Encoder] = {}


def _spaced(text: str) -> list[str]:
    """The pieces of a text, each with the white space before it, as keys: a word stands for the word after a
    space, a line break and a word for themselves, and any other piece for what follows its \\x01."""
    if not text:
        return []
    even = text[:1] not in " \n" and text[-1] not in " \n" and not any(x in text for x in ("  ", " \n", "\n ", "\n\n")) and not _OTHER_SPACE.search(text)
    if even:
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\x01" + keys[0]
        return keys
    pieces = _CHUNK.findall(text)
    return [p[1:] if p[0] == " " and not p[1:2].isspace() and len(p) > 1 else p if p[0] == "\n" and not p[1:2].isspace() and len(p) > 1 else "\x01" + p for p in pieces]


class _Known(dict):
    """Numbers of pieces; an unknown one gets the next number and is noted as fresh."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class Encoder:
    """Ids of texts, equal to the library's ``encode(text, add_special_tokens=False)``.

    A byte pair never joins text across the border between a run of non-space characters and the
    white space after it, so a text's ids are those of its pieces in a row. Natural text repeats its
    words, so most pieces come from the cache, and the ids of many texts are gathered by numpy at once.
    Marks of special tokens in a text are ordinary text.

    keep_space: pieces keep the white space before them (vocabularies in which it is text).
    """

    def __init__(self, path: str, keep_space: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split: Callable[[str], list[str]] = _spaced if keep_space else str.split
        # New pieces are encoded many at once, parted by a mark that is one token and part of none of them.
        self.mark = "\n" if keep_space else " \x01 "
        self.mark_ids = self._encode(self.mark)
        self.keep_space, self.model, self.short = keep_space, self.tokenizer.model, {}
        self.space = _BYTE_CHARS[32] if keep_space else ""
        for x in ".,\n":
            self.short[x] = self._encode(x).tolist()
        self._clear()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _clear(self) -> None:
        self.known = _Known()
        self.chars = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int32)  # calls that had the piece
        self.n = self.used = 0

    def _forget(self) -> None:
        """Drop the pieces of few calls, so that at most half of the cache stays."""
        n = self.n
        uses, starts, lengths, ids = self.uses[:n], self.starts[:n], self.lengths[:n], self.ids
        least = max(2, int(np.partition(uses, n // 2)[n // 2]) + 1) if n else 2
        pieces = list(self.known)
        stay = np.array([i for i in np.flatnonzero(uses >= least).tolist() if len(pieces[i]) <= _LASTING_CHARS], np.int64)
        self._clear()
        for i in stay.tolist():
            self.known[pieces[i]]
        total = lengths[stay]
        ends = np.cumsum(total)
        self._add(ids[np.repeat(starts[stay] - ends + total, total) + np.arange(ends[-1] if len(ends) else 0)], total)
        self.uses[: len(stay)] = uses[stay] // 2

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of all fresh pieces, in a row."""
        n, m = self.n, self.n + len(lengths)
        while m > len(self.starts):
            self.starts, self.lengths, self.uses = (np.resize(x, 2 * len(x)) for x in (self.starts, self.lengths, self.uses))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[n:m] = lengths
        self.uses[n:m] = 0
        self.starts[n:m] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.n = m
        self.chars += sum(map(len, self.known.fresh))
        self.known.fresh.clear()

    def _letters(self, key: str) -> list[int] | None:
        """The ids of a word of Latin-1 letters, maybe after a line break or with a comma or full stop: the library's model alone, as the steps before it leave such a word whole."""
        head = self.short["\n"] if key[0] == "\n" else []
        word = key[1:] if head else key
        word, tail = (word[:-1], self.short[word[-1]]) if word[-1:] in self.short else (word, [])
        if not word.isalpha() or not (word.isascii() or max(word) < "\u0100"):
            return None
        word = word if self.keep_space else word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        space = self.space if not head else ""
        return head + [t.id for t in self.model.tokenize(space + word)] + tail

    def _learn(self) -> None:
        """The ids of the fresh pieces."""
        new, tokenize, space, lower = self.known.fresh, self.model.tokenize, self.space, not self.keep_space
        rows: list[list[int] | np.ndarray | None] = []
        for x in new:
            if x.isascii() and x.isalpha():
                rows.append([t.id for t in tokenize(space + (x.lower() if lower else x))])
            else:
                rows.append(self._letters(x) if x else None)
        rest = [i for i, x in enumerate(rows) if x is None]
        plain = [i for i in rest if new[i][:1] not in ("", "\x01", "\n")]
        alone = [i for i in rest if new[i][:1] in ("", "\x01", "\n")]
        for at in range(0, len(plain), _AT_ONCE):
            part = plain[at : at + _AT_ONCE]
            ids = self._encode(self.mark.join([" " + new[i] if self.keep_space else new[i] for i in part]))
            marks = np.flatnonzero(ids == self.mark_ids[0])
            if len(self.mark_ids) == 1 and len(marks) == len(part) - 1:
                for i, found in zip(part, np.split(ids, marks), strict=True):
                    rows[i] = found if i == part[0] else found[1:]
            else:
                alone += part
        for i in alone:
            x = new[i]
            rows[i] = self._encode(x.removeprefix("\x01") if x[:1] in ("\x01", "\n") or not self.keep_space else " " + x)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        self._add(np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths)

    def __call__(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: none) as uint32."""
        texts = [t or "" for t in texts]
        if self.n > _CACHE_PIECES[self.keep_space] or self.chars > _CACHE_CHARS:
            self._forget()
        odd = [_ODD.search(t) is not None for t in texts]
        split = [[] if o else self.split(t) for t, o in zip(texts, odd, strict=True)]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.known.fresh:
            self._learn()
        self.uses[at] += 1
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        borders = np.concatenate([np.zeros(1, np.int64), ends])[np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])]
        return [self._encode(t) if o else ids[borders[k] : borders[k + 1]] for k, (t, o) in enumerate(zip(texts, odd, strict=True))]


def encoder(path: str, keep_space: bool) -> Encoder:
    """One encoder for each vocabulary file in a worker process; its cache lives on between tasks."""
    if (path, keep_space) not in _encoders:
        _encoders[path, keep_space] = Encoder(path, keep_space)
    return _encoders[path, keep_space]


def largest_id(path: str) -> int:
    """The largest id of a vocabulary file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
