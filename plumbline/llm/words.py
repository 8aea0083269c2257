"""Hashes of all words of an Arrow string array, without a Python loop over words; a table of bounded size for what was met before."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20240229)
_LETTER = _random.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
#: Bytes after which the factors of ``string_hashes`` begin again.
_CYCLE = 4096

#: The six characters of white space in ASCII separate words; only A to Z are folded.
ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ASCII_FOLD = np.arange(256, dtype=np.uint8)
ASCII_FOLD[65:91] += 32
#: Everything in ASCII but letters and digits separates words.
ASCII_PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _ODD)]))
    return _powers[:n]


def word_hashes(array: pa.Array, separators: np.ndarray = ASCII_SPACE, fold: np.ndarray = ASCII_FOLD) -> tuple[np.ndarray, np.ndarray]:
    """Words per row, and the 64-bit hashes of the words of all rows in order. Null rows have no words.

    A word is a longest run of bytes that are not ``separators``; equal words, after ``fold``, have equal hashes.
    """
    array = pc.fill_null(array, "").cast(pa.large_string())
    rows = len(array)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + rows + 1]
    if not rows or offsets[-1] == offsets[0]:
        return np.zeros(rows, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    per_row = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return per_row, np.zeros(0, np.uint64)
    # The part before the first word belongs to no word and is all separators.
    begin = starts[0]
    spread = np.diff(np.append(starts, len(data)))
    place = np.arange(begin, len(data)) - np.repeat(starts, spread)
    value = _LETTER[fold[data[begin:]]] * _power(int(spread.max()))[place]
    value *= inside[begin:]
    return per_row, mix(np.add.reduceat(value, starts - begin))


def string_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings that lie one behind the other in ``data``, each up to its place in ``ends``."""
    sizes = np.diff(ends, prepend=0)
    out, filled = sizes.astype(np.uint64), np.flatnonzero(sizes)
    if len(filled):
        place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        place %= _CYCLE
        value = _power(_CYCLE)[place]
        value *= _LETTER[data]
        out[filled] += np.add.reduceat(value, (ends - sizes)[filled])
    return mix(out)


class Recent(dict):
    """A table of at most about ``2 * most`` entries. Filled once, it keeps what is used again before the next time."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def put(self, key, value):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def old(self, key):
        value = self.older.get(key)
        return None if value is None else self.put(key, value)
