"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np

# Texts are worked on together up to this many bytes; a longer text comes alone.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Marks that the tail of a word may be split off at, and what may stand before the tail.
_TAIL = np.zeros(256, bool)
_TAIL[np.frombuffer(b'.,!?;:%&*$#"', np.uint8)] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[97:123] = True
_VALUE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(n + n // 4, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words(NamedTuple):
    """``data`` holds the texts with a space after each; a word is ``data[start:end]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray  # words of text i are offsets[i] to offsets[i + 1]

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are worked on together."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if i > begin and total + len(text) > SLICE_BYTES:
            yield begin, i
            begin, total = i, 0
        total += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def encoded(texts) -> list[bytes]:
    """UTF-8 of texts, empty for null."""
    return [t.encode() if isinstance(t, str) else b"" for t in texts]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, from differences of one running polynomial."""
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def scan(texts: list[bytes], lower: bool = False, tails: bool = False) -> Words:
    """Words of the texts: runs of anything but ASCII white space.

    ``lower`` lowers A-Z first. ``tails`` makes punctuation after a letter or digit at the
    end of a word a word of its own. Two different words have the same hash with a chance
    of 2^-64.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    if tails and len(start):
        last = np.maximum.accumulate(np.where(_TAIL[data], -1, np.arange(len(data))))[end - 1]
        cut = (last >= start) & (last < end - 1) & _PLAIN[data[last]]
        at = np.flatnonzero(cut)
        start = np.insert(start, at + 1, last[at] + 1)
        end = np.insert(end, at, last[at] + 1)
    hashed = hashes(data, start, end)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    return Words(data, start, end, hashed, np.searchsorted(start, begins))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the place of one of each, and for every value the number of its distinct one."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], order[new], number


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin[i], begin[i] + 1, ... (count[i] of them), for all i in turn."""
    total = np.cumsum(count)
    if not len(total):
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(begin - (total - count), count)


class WordTable:
    """What a function of words gives, kept by the words' hashes, for words seen before.

    ``compute`` takes words and returns their values end to end and the number for each.
    The table starts anew when it holds more than ``most`` words, so memory is bounded.
    """

    def __init__(self, compute: Callable, dtype, most: int = 1_000_000):
        self.compute, self.dtype, self.most = compute, dtype, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted, with the place of each word's values
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.values, self.used = np.zeros(0, self.dtype), 0

    def _add(self, keys: np.ndarray, values: np.ndarray, count: np.ndarray) -> None:
        if self.used + len(values) > len(self.values):
            room = np.zeros(int(1.3 * (self.used + len(values))), self.dtype)
            room[: self.used] = self.values[: self.used]
            self.values = room
        self.values[self.used : self.used + len(values)] = values
        begin = self.used + np.cumsum(count) - count
        self.used += len(values)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.count = np.insert(self.count, at, count)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Values of all words end to end, and the number for each text."""
        if len(self.keys) > self.most:
            self.clear()
        keys, at, number = distinct(words.hash)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            values, count = self.compute([words.bytes_of(at[i]) for i in new])
            self._add(keys[new], values, count)
            place = np.searchsorted(self.keys, keys)
        rows = place[number]
        count = self.count[rows].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(count)])
        return self.values[spread(self.begin[rows], count)], np.diff(total[words.offsets])
