"""Ids of whole texts by way of their words and pieces, each worked out when first met and looked up afterwards.

Texts are cut before single spaces, where no piece of the split patterns of byte-level vocabularies goes on. Only words
not met before are cut to pieces, and only pieces not met before are given to the model. What was met lies in tables of
bounded size, in flat arrays; dropping them changes no result. An owner of another pattern or model says how words,
stretches with white space and pieces become ids.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plumbline.llm.words import string_hashes

#: Ids of several strings one behind the other, and how many each has.
Ids = tuple[np.ndarray, np.ndarray]


def pick(ids: Ids, which: np.ndarray) -> Ids:
    """Those of the strings ``which``, in that order."""
    flat, sizes = ids
    n = sizes[which]
    begins, ends = (np.cumsum(sizes) - sizes)[which], np.cumsum(n)
    return flat[np.repeat(begins - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n


def behind(*several: Ids) -> Ids:
    return np.concatenate([flat for flat, _ in several]), np.concatenate([sizes for _, sizes in several])


class Known:
    """Ids of strings met before, in flat arrays. Beyond ``most`` bytes the half that was not used of late is dropped.

    Strings are found by their sorted hashes and compared in full, so that a look-up costs what is asked and not what is
    held. Of several that share a hash one is found; the others are encoded again each time.
    """

    def __init__(self, most: int, kind: str):
        self.most, self.turn, self.keys = most, 0, pa.array([], pa.string())
        self.ids, self.used = (np.zeros(0, kind), np.zeros(0, np.int64)), np.zeros(0, np.int64)
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def _find(self, keys: pa.Array, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place of each of ``keys``, -1 if it is not held. ``at`` is where its hash belongs."""
        place = np.full(len(keys), -1, np.int64)
        like = np.flatnonzero(at < len(self.hashes))
        like = like[self.hashes[at[like]] == hashes[like]]
        held = self.places[at[like]]
        same = pc.equal(keys.take(pa.array(like)), self.keys.take(pa.array(held))).to_numpy(zero_copy_only=False)
        place[like[same]] = held[same]
        return place

    def look_up(self, keys: pa.Array, encode: Callable[[pa.Array], Ids]) -> Ids:
        """Ids of distinct ``keys``; those not met before are encoded and kept."""
        self.turn += 1
        hashes = string_hashes(*flat_bytes(keys))
        order, at = np.argsort(hashes), np.zeros(len(keys), np.int64)
        at[order] = np.searchsorted(self.hashes, hashes[order])
        place = self._find(keys, hashes, at)
        new = np.flatnonzero(place < 0)
        if len(new):
            made = keys.take(pa.array(new))
            place[new] = len(self.keys) + np.arange(len(new))
            self.ids, self.keys = behind(self.ids, encode(made)), pa.concat_arrays([self.keys, made])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
            new = order[place[order] >= len(self.keys) - len(new)]
            self.hashes, self.places = np.insert(self.hashes, at[new], hashes[new]), np.insert(self.places, at[new], place[new])
        self.used[place] = self.turn
        out = pick(self.ids, place)
        if self.keys.nbytes + self.ids[0].nbytes > self.most:
            stays = self.used > np.median(self.used)
            kept, still = np.flatnonzero(stays), stays[self.places]
            self.ids, self.keys, self.used = pick(self.ids, kept), self.keys.take(pa.array(kept)), self.used[kept]
            self.hashes, self.places = self.hashes[still], (np.cumsum(stays) - 1).astype(np.int32)[self.places[still]]
        return out


class PieceIds:
    """The way from a column of texts to ids; ``kind`` is the type of an id, ``most`` the bytes of each table."""

    def __init__(self, kind: str, most: int):
        self.kind, self.most = kind, most
        self.forget()

    def forget(self) -> None:
        """Drop the words and pieces, which fill again soon."""
        self.words, self.pieces = (Known(self.most, self.kind) for _ in range(2))

    def _words(self, words: pa.Array) -> Ids:
        """Ids of words behind a space each; none ends with white space."""
        raise NotImplementedError

    def _runs(self, runs: list[str]) -> Ids:
        """Ids of stretches of text."""
        raise NotImplementedError

    def _pieces(self, pieces: pa.Array) -> Ids:
        """Ids of pieces by the model alone."""
        raise NotImplementedError

    def _array(self, ids: list[int]) -> np.ndarray:
        return np.array(ids, self.kind)

    def of_texts(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of a string column without nulls."""
        cut = pc.split_pattern(column, " ")
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64))
        coded = cut.flatten().dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        goes_on = _goes_on(words)
        closed = np.flatnonzero(~goes_on)
        flat, n = self.words.look_up(words.take(pa.array(closed)), self._words)
        sizes = np.zeros(len(words), np.int64)
        sizes[closed] = n
        # A part that is empty or ends with white space makes one run with the parts behind it. The first part of a
        # text has no space before it.
        begins = goes_on[which]
        joined = begins.copy()
        joined[ends - 1] = False
        begins[ends[:-1]] = begins[:1] = True
        begins[1:] &= ~joined[:-1]
        at, lasts = np.flatnonzero(begins), np.flatnonzero(~joined)
        n_parts = lasts[np.searchsorted(lasts, at)] + 1 - at
        inside = np.repeat(at - np.cumsum(n_parts) + n_parts, n_parts) + np.arange(n_parts.sum())
        parts, first = iter(words.take(pa.array(which[inside])).to_pylist()), set(ends.tolist()) | {0}
        runs = ["" if i in first else " " for i in at.tolist()]
        runs = [lead + " ".join(itertools.islice(parts, k)) for lead, k in zip(runs, n_parts.tolist(), strict=True)]
        numbers = {run: i for i, run in enumerate(dict.fromkeys(runs))}
        which[inside] = len(words) + len(numbers)
        which[at] = [len(words) + numbers[run] for run in runs]
        ids = behind((flat, sizes), self._runs(list(numbers)), (self._array([]), np.zeros(1, np.int64)))
        flat, n = pick(ids, which)
        return _cut(flat, np.cumsum(n)[ends - 1] if len(ends) else ends)

    def _cut_to(self, pieces: list[str], ends: np.ndarray) -> Ids:
        """Ids of strings that are cut to ``pieces``, each up to its place in ``ends``."""
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        flat, n = pick(self.pieces.look_up(coded.dictionary, self._pieces), coded.indices.to_numpy())
        return flat, np.diff(np.concatenate([[0], np.cumsum(n)])[ends], prepend=0)


def join(strings: pa.Array, between: str | bytes) -> str | bytes:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), between)[0].as_py()


def flat_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the end of each string in them."""
    lengths = pc.binary_length(words).to_numpy().astype(np.int64)
    ends, begin = np.cumsum(lengths), np.frombuffer(words.buffers()[1], np.int32, 1, 4 * words.offset)[0] if len(words) else 0
    total = int(ends[-1]) if len(words) else 0
    return (np.frombuffer(words.buffers()[2], np.uint8, total, begin) if total else np.zeros(0, np.uint8)), ends


def _goes_on(words: pa.Array) -> np.ndarray:
    """Whether a word is empty or ends with white space."""
    data, ends = flat_bytes(words)
    last = np.where(np.diff(ends, prepend=0) > 0, np.append(data, np.uint8(32))[ends - 1], 32)
    out = last <= 32
    wide = np.flatnonzero(last >= 128)
    out[wide] = [word[-1].isspace() for word in words.take(pa.array(wide)).to_pylist()]
    return out


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data, w = ids.tobytes(), ids.itemsize
    return [data[begin:end] for begin, end in itertools.pairwise([0, *(w * ends).tolist()])]
