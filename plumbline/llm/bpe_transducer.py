"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decode.

Rank files give every token the order in which its merge was learned. A sequence of tokens is what those merges make
of its bytes exactly if every token and every two neighbours are what the merges make of their own bytes. So each
prefix of a word has one last token, and a machine that reads bytes can find it from the positions at which a token
may still begin. ``Transducer`` runs that machine on sets of such positions: a state is the set of open positions
(their trie nodes), each with the token that ends where it begins. A state therefore tells the last token of what was
read up to there; the ids of a word are those met on the way back from its end, a token's length at a time. States and
transitions are made when first met and kept; beyond ``most_states`` they are dropped and made again, which bounds
memory and changes no result. Transitions lie in flat integer arrays, and many words take their next step at once.
Words and pieces met before are looked up (see ``piece_ids``), so only new pieces pass the machine.

Ids are decoded in pieces of bounded size. ``Utf8Stream`` follows the bytes with a table of states, so that a character
that is cut by the end of a piece waits for the rest.

Defined results: a null text is the empty text; the empty text has no ids and decodes to no bytes; rows with a null
or repeated ``doc_id`` are encoded like any other, one result row each; whole texts are encoded whatever their length;
columns besides the two named ones are ignored, whatever their names. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.piece_ids import Ids, PieceIds, flat_bytes, join

#: Bytes of the words, and of the pieces, kept with their ids by each task.
KNOWN_BYTES = 8 << 20
MOST_STATES = 200_000
#: Up to so many words that are still open walk on alone.
FEW = 4
#: Bytes of text encoded at a time; a longer text stands alone.
TEXT_SLICE = 2 << 20
#: Bytes of new pieces that pass the machine together; a longer piece stands alone.
PIECE_BYTES = 1 << 19
#: Ids decoded at a time.
DECODE_IDS = 65_536


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Bytes of one word in, token ids out. ``ranks`` holds every single byte."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.most_states = most_states
        self.lengths = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        self.lengths[list(ranks.values())] = list(map(len, ranks))
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                following = self.children[node].get(byte)
                if following is None:
                    following = len(self.children)
                    self.children[node][byte] = following
                    self.children.append({})
                    self.token_at.append(-1)
                node = following
            self.token_at[node] = rank
        self.restart()

    def restart(self, kept: np.ndarray | tuple = ()) -> np.ndarray:
        """Drop all states but the start and those in ``kept``; their new numbers."""
        open_ = [self.states[state] for state in kept]
        self.states: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.last = array("i")  # of each state, the token that ends there
        self.steps = Steps()
        self.pairs: dict[int, bool] = {}
        self.number((0, -1))
        return np.array([self.number(state) for state in open_], np.int64)

    def number(self, state: tuple[int, ...]) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.last.append(state[-1])
        return number

    def last_merge(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging joins last into ``token``; None for single bytes and for tokens it never makes."""
        known = self.made_of.get(token, False)
        if known is not False:
            return known
        data, ranks = self.tokens[token], self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            best, at = token, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], token)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        self.made_of[token] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return self.made_of[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` next to each other; ``left`` is -1 at the start of a word.

        Merges are undone from the last to the first. The two tokens that touch at the border at some time would be
        joined if their merge comes before the merge undone last, that is, before one of them was made (of equal
        ranks, the one further left is made first).
        """
        ranks, tokens = self.ranks, self.tokens
        a, b, right_of, left_of = tokens.get(left, b""), tokens[right], self.last_merge(left) if left >= 0 else None, self.last_merge(right)
        if (len(a) > 1 and right_of is None) or (len(b) > 1 and left_of is None):
            return False
        until = len(self.lengths)  # ranks below it would be merged while a and b touch
        while a:
            if ranks.get(a + b, until) < until:
                return False
            if right_of is not None and (left_of is None or left > right):
                until, left = left, right_of[1]
                a, right_of = tokens[left], self.last_merge(left)
            elif left_of is not None:
                until, right = right + 1, left_of[0]
                b, left_of = tokens[right], self.last_merge(right)
            else:
                break
        return True

    def step(self, state: int, byte: int) -> int:
        """The state after ``byte``. A state is the trie node of each open position, the longest first, and behind each
        node the token that ends where the position begins; the last position is the place reached."""
        following, last = [], None
        children, token_at, pairs = self.children, self.token_at, self.pairs
        parts = iter(self.states[state])
        for node, before in zip(parts, parts, strict=True):
            child = children[node].get(byte)
            if child is None:
                continue
            if last is None and (token := token_at[child]) >= 0:
                valid = pairs.get(before << 20 | token)
                if valid is None:
                    valid = pairs[before << 20 | token] = self.neighbours(before, token)
                if valid:
                    last = token
            if children[child]:
                following += child, before
        return self.number((*following, 0, last))

    def encode(self, word: bytes) -> list[int]:
        return self.encode_words(word, np.array([len(word)]))[1].tolist()

    def encode_words(self, data: bytes | np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids) of words that lie one behind the other in ``data``.

        All words that are not at their end take one step together. A long word walks on alone, byte by byte.
        """
        read = np.frombuffer(data, np.uint8)
        ends = np.cumsum(lengths)
        words = np.flatnonzero(lengths)
        last = np.zeros(len(read), np.int32)  # token of the word's bytes up to each place
        at, end, state = (ends - lengths)[words], ends[words], np.zeros(len(words), np.int64)
        while len(at) > FEW:
            if len(self.states) > self.most_states:
                state = self.restart(state)
            state = self.follow(state << 8 | read[at])
            last[at] = _view(self.last, np.int32)[state]
            at = at + 1
            more = at < end
            at, end, state = at[more], end[more], state[more]
        reached = [self.states[number] for number in state.tolist()]
        for place, to, now in zip(at.tolist(), end.tolist(), reached, strict=True):
            last[place:to] = self._walk(self.number(now), read[place:to].tobytes())
        # Back from the end of each word. A token is one of the word's if it is the last one where the next begins.
        chosen = np.zeros(len(read), bool)
        at, begin = ends[words] - 1, (ends - lengths)[words]
        while len(at) > FEW:
            chosen[at] = True
            at = at - self.lengths[last[at]]
            more = at >= begin
            at, begin = at[more], begin[more]
        for place, to in zip(at.tolist(), begin.tolist(), strict=True):
            while place >= to:
                chosen[place] = True
                place -= self.lengths.item(last.item(place))
        counts = np.diff(np.concatenate([[0], np.cumsum(chosen)])[ends], prepend=0)
        return counts, last[chosen].astype("<u4")

    def _walk(self, state: int, data: bytes) -> np.ndarray:
        """The last token behind each byte of ``data``, read from ``state`` on."""
        out = array("i")
        for byte in data:
            following = self.steps.get(state << 8 | byte)
            if following < 0:
                if len(self.states) > self.most_states:
                    state = int(self.restart((state,))[0])
                following = int(self.follow(np.array([state << 8 | byte]))[0])
            state = following
            out.append(self.last[state])
        return np.array(out, np.int32)

    def follow(self, keys: np.ndarray) -> np.ndarray:
        """The states after (state, byte) pairs; those never met are made."""
        state = self.steps.find(keys)
        new = np.flatnonzero(state < 0)
        if len(new):
            made, which = np.unique(keys[new], return_inverse=True)
            states = np.array([self.step(key >> 8, key & 255) for key in made.tolist()], np.int32)
            self.steps.add(made, states)
            state[new] = states[which]
        return state


def _view(numbers: array, kind: type) -> np.ndarray:
    return np.frombuffer(numbers, kind) if len(numbers) else np.zeros(0, kind)


class Steps:
    """States after (state, byte) pairs, in an open hash table of two integer arrays, at most half full."""

    def __init__(self):
        self.size = 0
        self._new_table(1 << 12)

    def _new_table(self, size: int) -> None:
        self.keys, self.to, self.mask = np.full(size, -1, np.int64), np.zeros(size, np.int32), size - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 >> 12) & self.mask

    def get(self, key: int) -> int:
        slot = (key * 0x9E3779B1 >> 12) & self.mask
        while (there := self.keys.item(slot)) != key:
            if there < 0:
                return -1
            slot = (slot + 1) & self.mask
        return self.to.item(slot)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.to[slot], -1).astype(np.int64)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.to[slot[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return out

    def add(self, keys: np.ndarray, to: np.ndarray) -> None:
        """Distinct new ``keys``."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            old = self.keys >= 0
            keys, to = np.concatenate([self.keys[old], keys]), np.concatenate([self.to[old], to])
            size = len(self.keys)
            while size < 4 * self.size:
                size *= 2
            self._new_table(size)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.to[slot[won]] = keys[won], to[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, to, slot = keys[rest], to[rest], (slot[rest] + 1) & self.mask


class Decoder:
    """Token ids back to bytes, by one gather from the bytes of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.lengths = np.fromiter(map(len, by_id), np.int64, size)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def bytes_of(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        return self.blob[np.repeat(self.begins[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


def _utf8_table() -> np.ndarray:
    """``table[state, byte]`` is the next state. 0: between characters; 1 to 3: so many bytes of any kind are to follow;
    the others narrow the byte after E0, ED, F0 and F4; 8: no UTF-8. See table 3-7 of the Unicode standard."""
    table = np.full((9, 256), 8, np.uint8)
    lead, follow = table[0], slice(0x80, 0xC0)
    lead[:0x80], lead[0xC2:0xE0], lead[0xE0:0xF0], lead[0xF0:0xF4] = 0, 1, 2, 3
    lead[0xE0], lead[0xED], lead[0xF0], lead[0xF4] = 4, 5, 6, 7
    table[1, follow], table[2, follow], table[3, follow] = 0, 1, 2
    table[4, 0xA0:0xC0], table[5, 0x80:0xA0], table[6, 0x90:0xC0], table[7, 0x80:0x90] = 1, 1, 2, 2
    return table


UTF8 = _utf8_table()


class Utf8Stream:
    """Text of a byte stream as it arrives, by a machine of nine states.

    The machine starts anew at each lead byte, so its state behind a piece depends on the bytes from the last lead
    byte on, four at most. Bytes of a character that is not complete are held back; bytes that are no UTF-8 become
    U+FFFD.
    """

    def __init__(self):
        self.state, self.open = 0, b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        lead = len(data) - 1
        while lead > max(-1, len(data) - 4) and 0x80 <= data[lead] < 0xC0:
            lead -= 1
        state = 0
        for byte in data[max(lead, 0) :]:
            state = int(UTF8[state, byte])
        cut = len(data) if state in (0, 8) else max(lead, 0)
        self.state, self.open = (0, b"") if cut == len(data) else (state, data[cut:])
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.state, self.open = self.open, 0, b""
        return rest.decode("utf-8", "replace")


class Codec(PieceIds):
    """One vocabulary with its split pattern: whole texts to ids (little-endian 32-bit) and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        super().__init__("<u4", KNOWN_BYTES)
        # Two names of one set; libraries differ in what the short ones mean for a few control characters.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.machine = Transducer(ranks)
        self.decoder = Decoder(ranks)

    def _pieces(self, pieces: pa.Array) -> Ids:
        data, ends = flat_bytes(pieces)
        sizes, made, begin, start = [], [self._array([])], 0, 0
        while begin < len(ends):
            end = max(begin + 1, int(np.searchsorted(ends, start + PIECE_BYTES, "right")))
            n, ids = self.machine.encode_words(data[start : ends[end - 1]], np.diff(ends[begin:end], prepend=start))
            sizes.append(n)
            made.append(ids)
            begin, start = end, int(ends[end - 1])
        return np.concatenate(made), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _words(self, words: pa.Array) -> Ids:
        if not len(words):
            return self._array([]), np.zeros(0, np.int64)
        pieces = self.split.findall(" " + join(words, " "))
        ends = np.cumsum(pc.utf8_length(words).to_numpy().astype(np.int64) + 1)
        reached = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return self._cut_to(pieces, np.searchsorted(reached, ends) + 1)

    def _runs(self, runs: list[str]) -> Ids:
        cut = [self.split.findall(run) for run in runs]
        return self._cut_to(list(itertools.chain.from_iterable(cut)), np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))))

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        return self.of_texts(pa.array(texts, pa.string()))

    def decode_stream(self, ids: bytes) -> Iterator[bytes]:
        numbers = np.frombuffer(ids, "<u4")
        for begin in range(0, len(numbers), DECODE_IDS):
            yield self.decoder.bytes_of(numbers[begin : begin + DECODE_IDS])


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a task, which drops it at its end: a worker goes on to other work."""
    return Codec(load_ranks(path), pattern)


def _worker_path(path: str, shipped: bool) -> str:
    return SparkFiles.get(path) if shipped else path


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", shipped: bool = False) -> DataFrame:
    """(doc_id, ids binary): the ids of each whole text as little-endian unsigned 32-bit integers.

    ``path`` is the rank file at the same place on every worker, or with ``shipped`` the name under which it was added
    with ``SparkContext.addFile``.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(_worker_path(path, shipped), pattern)
        for batch in batches:
            for begin, end in common.slices(batch.column(1), TEXT_SLICE):
                part = batch.slice(begin, end - begin)
                ids = pa.array(own.of_texts(pc.fill_null(part.column(1), "")), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])
        del own
        codec.cache_clear()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        common.tidy(run), f"doc_id {kind.simpleString()}, ids binary"
    )


def decode(encoded: DataFrame, path: str, pattern: str, *, shipped: bool = False) -> DataFrame:
    """(doc_id, text, n_bytes) of an ``encode`` result, decoded as a stream; null ids are no ids."""
    kind = encoded.schema["doc_id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(_worker_path(path, shipped), pattern)
        for batch in batches:
            out, sizes = [], []
            for ids in batch.column(1).to_pylist():
                stream, size, parts = Utf8Stream(), 0, []
                for data in own.decode_stream(ids or b""):
                    size += len(data)
                    parts.append(stream.feed(data))
                out.append("".join(parts) + stream.end())
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(sizes, pa.int64())], ["doc_id", "text", "n_bytes"])
        del own
        codec.cache_clear()

    return encoded.select("doc_id", "ids").mapInArrow(common.tidy(run), f"doc_id {kind.simpleString()}, text string, n_bytes bigint")


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", shipped: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded and its ids decoded again in the same pass."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(_worker_path(path, shipped), pattern)
        for batch in batches:
            for begin, end in common.slices(batch.column(1), TEXT_SLICE):
                part = batch.slice(begin, end - begin)
                counts, shas, back = [], [], []
                for ids in own.of_texts(pc.fill_null(part.column(1), "")):
                    counts.append(len(ids) // 4)
                    shas.append(hashlib.sha256(ids).hexdigest())
                    seen, stream = hashlib.sha256(), Utf8Stream()
                    for data in own.decode_stream(ids):
                        seen.update(stream.feed(data).encode())
                    seen.update(stream.end().encode())
                    back.append(seen.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        del own
        codec.cache_clear()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        common.tidy(run), f"doc_id {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
