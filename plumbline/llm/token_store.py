"""Token ids in shard files with a minimal perfect hash index from document keys to places.

Layout of a store, three Parquet tables below one folder, written by Spark's own committer so that any file system
will do and a lost executor leaves no half file:

* ``payload``: blocks of whole documents in ascending key order, a shard per range of keys. The ``data`` of a block is
  ``MAGIC``, the width of an id in bytes, the number of documents, their token counts (32-bit) and the raw ids.
* ``index``: a table per bucket of hashed keys. Its keys sit in levels of bit arrays: a key that is alone at its place
  of a level stays there, others go to the next level. The rank of its bit is the key's number, without gaps. The
  bucket keeps, by number, a 32-bit fingerprint of the key, shard, block, place in the block, first id and number of
  rows. A look-up takes about two probes whatever the size; a key that was never stored is told by its fingerprint
  (all but one in four thousand million).
* ``shards``: first id, rows and ids of each shard.

Defined results: a null text is the empty text and holds the end id only; rows with a null key come first and are in
the payload but not in the index; rows that repeat a key lie next to each other, ordered by a hash of their texts, and
may fill several shards; the index has the place of the first and their number; whole texts are encoded; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.piece_ids import Ids, PieceIds, behind, flat_bytes, join, pick
from plumbline.llm.words import mix

MAGIC = b"TOK1"
#: Bytes of ids in a block, unless one document has more, and rows of a shard.
BLOCK_BYTES = 1 << 20
SHARD_ROWS = 20_000
#: Keys of an index bucket; a bucket is built and kept as a whole.
BUCKET_KEYS = 32_768
END_ID = 2
#: Bits of a level for each key left.
GAMMA = 2
#: Bytes of the words, and of the pieces, kept with their ids by each worker.
KNOWN_BYTES = 8 << 20
#: Bytes of text encoded at a time.
TEXT_SLICE = 2 << 20
#: Words of code points below it are cut to pieces here: Latin letters, digits, marks, controls. The first whose first
#: byte is C9.
PLAIN = 0x240
PAYLOAD = "shard int, block int, rows int, keys array<long>, data binary"


def _classes() -> tuple[str, str, str]:
    """White space, letters and numbers among the code points below ``PLAIN``, as they stand in a pattern."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(PLAIN)]
    letters, numbers = ("".join(chr(c) for c in range(PLAIN) if kinds[c] == kind) for kind in "LN")
    return "\\t-\\r \x85\xa0", letters, numbers


def _split_plain() -> re.Pattern:
    """The split pattern of ``ByteLevel`` for texts of code points below ``PLAIN``."""
    space, letters, numbers = _classes()
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


def _byte_letters() -> str:
    """The letter by which byte-level vocabularies write each byte. FF, which no text holds, is a line break here."""
    out, others = [], 256
    for byte in range(256):
        own = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        out.append(chr(byte if own else others))
        others += not own
    out[255] = "\n"
    return "".join(out)


SPLIT, LETTERS, NOT_PLAIN = _split_plain(), _byte_letters(), re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")
LETTER_CODES = np.array([ord(letter) for letter in LETTERS], "<u4")


class Encoder(PieceIds):
    """A vocabulary of the tokenizers library. Words and pieces met before are remembered with their ids.

    Texts are cut before single spaces, where no piece of the split pattern goes on. Only words not met before are cut
    to pieces, and only pieces not met before are given to the library's model, many in one call and without the passes
    of its pattern. Words are cut here if all their characters are below ``PLAIN``, whose classes no version of Unicode
    changes; other words go through the library's own pattern, a line each: a single line break behind a word is a token
    of its own, so the ids between line breaks are those of the words. Texts that hold an added token of the vocabulary,
    as ``<|endoftext|>`` is, are given to the library whole: it makes one id of it, also inside a word. So are all texts
    if the file asks for more than byte-level pieces (normalizers, other patterns, truncation).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values() if token.content]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.byte_level = is_byte_level(path) and all(letter in vocabulary for letter in pre_tokenizers.ByteLevel.alphabet())
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        super().__init__(f"<u{self.width}", KNOWN_BYTES)
        self.line_break = vocabulary.get(LETTERS[10])

    def _whole(self, text: str) -> np.ndarray:
        return self._array(self.library.encode(text, add_special_tokens=False).ids)

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of a string column; null is empty."""
        column = pc.fill_null(column, "")
        whole = np.full(len(column), not self.byte_level)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        out = self.of_texts(pc.if_else(pa.array(whole), "", column) if whole.any() else column)
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._whole(column[i].as_py()).tobytes()
        return out

    def _runs(self, runs: list[str]) -> Ids:
        """Ids of stretches of text."""
        plain = [i for i, run in enumerate(runs) if not NOT_PLAIN.search(run)]
        others = [i for i, run in enumerate(runs) if NOT_PLAIN.search(run)]
        cut = [SPLIT.findall(runs[i]) for i in plain]
        made = [self._whole(runs[i]) for i in others]
        flat, sizes = self._cut_to(list(itertools.chain.from_iterable(cut)), np.cumsum([len(pieces) for pieces in cut], dtype=np.int64))
        ids = behind((flat, sizes), (np.concatenate([self._array([]), *made]), np.array([len(m) for m in made], np.int64)))
        return pick(ids, np.argsort(plain + others))

    def _words(self, words: pa.Array) -> Ids:
        """Ids of words behind a space each; none ends with white space. Plain ones are cut by one pass of the pattern."""
        is_plain = _is_plain(words)
        plain, others = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        ids = self._array([]), np.zeros(0, np.int64)
        if len(plain):
            asked = words.take(pa.array(plain))
            pieces = SPLIT.findall(" " + join(asked, " "))
            reached = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            ids = self._cut_to(pieces, np.searchsorted(reached, np.cumsum(pc.utf8_length(asked).to_numpy() + 1, dtype=np.int64)) + 1)
        lines, spaced = [], []
        for i, word in zip(others.tolist(), words.take(pa.array(others)).to_pylist(), strict=True):
            (lines if word.split() == [word] else spaced).append((i, word))
        made = [self._whole(" " + word) for _, word in spaced]
        ids = behind(ids, self._lines([word for _, word in lines]), (np.concatenate([self._array([]), *made]), np.array([len(m) for m in made], np.int64)))
        return pick(ids, np.argsort(np.concatenate([plain, [i for i, _ in lines + spaced]]).astype(np.int64)))

    def _pieces(self, pieces: pa.Array) -> Ids:
        """Ids of pieces by the model alone. Tokens have as many bytes as what they stand for, which tells the ends."""
        asked = LETTER_CODES[np.frombuffer(join(pieces.cast(pa.binary()), b"\xff"), np.uint8)].tobytes().decode("utf-32-le")
        ids = self._array(self.model.encode_batch_fast([asked], add_special_tokens=False)[0].ids)
        reached, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(pc.binary_length(pieces).to_numpy().astype(np.int64))
        places = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or (reached[places] != ends).any():
            raise ValueError("the vocabulary is not one of bytes")
        return ids, np.diff(places + 1, prepend=0)

    def _lines(self, words: list[str]) -> Ids:
        """Ids of words without white space, behind a space each, through the library's own pattern."""
        if not words:
            return self._array([]), np.zeros(0, np.int64)
        ids = self._array(self.library.encode_batch_fast([" " + "\n ".join(words) + "\n"], add_special_tokens=False)[0].ids)
        return ids[ids != self.line_break], np.diff(np.flatnonzero(ids == self.line_break), prepend=-1) - 1


def _is_plain(words: pa.Array) -> np.ndarray:
    """Whether all characters of a word are below ``PLAIN``, so that none begins with a byte as high as its first."""
    data, ends = flat_bytes(words)
    high = np.concatenate([[0], np.cumsum(data >= chr(PLAIN).encode()[0])])[ends]
    return np.diff(high, prepend=0) == 0


def is_byte_level(path: str) -> bool:
    """Whether the ids of a text are those of the pieces of the byte-level pattern, one behind the other."""
    with open(path, encoding="utf-8") as file:
        state = json.load(file)
    cutter, model = state.get("pre_tokenizer") or {}, state["model"]
    return (
        not any(state.get(name) for name in ("normalizer", "truncation", "padding"))
        and (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex", True)) == ("ByteLevel", False, True)
        and (model.get("type"), model.get("dropout") or None) == ("BPE", None)
        and not any(model.get(name) for name in ("continuing_subword_prefix", "end_of_word_suffix"))
    )


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack_block(width: int, counts: list[int], ids: list[bytes]) -> bytes:
    return MAGIC + struct.pack("<II", width, len(counts)) + np.array(counts, "<u4").tobytes() + b"".join(ids)


def unpack_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of the documents and all their ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    width, n = struct.unpack_from("<II", data, 4)
    return np.frombuffer(data, "<u4", n, 12), np.frombuffer(data, f"<u{width}", -1, 12 + 4 * n)


# --- Minimal perfect hashing -------------------------------------------------------------------------------------


def key_hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _place(hashed: np.ndarray, level: int, bits: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64)
    return (mix(hashed + salt) % np.uint64(bits)).astype(np.int64)


def build_levels(hashed: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the levels for distinct hashes."""
    levels = []
    while len(hashed):
        bits = max(64, GAMMA * len(hashed))
        place = _place(hashed, len(levels), bits)
        alone = np.bincount(place, minlength=bits) == 1
        levels.append(alone)
        hashed = hashed[~alone[place]]
    return levels


def number_of(hashed: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The number of each hash, below the number of keys; -1 for some of those never stored."""
    out, open_, before = np.full(len(hashed), -1, np.int64), np.arange(len(hashed)), 0
    for level, alone in enumerate(levels):
        place = _place(hashed[open_], level, len(alone))
        here = alone[place]
        ranks = np.cumsum(alone) - 1
        out[open_[here]] = before + ranks[place[here]]
        before += int(alone.sum())
        open_ = open_[~here]
    return out


def fingerprint(hashed: np.ndarray) -> np.ndarray:
    return (mix(hashed ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.int64)


FIELDS = ("shard", "block", "place", "start", "rows")


def build_index(entries: DataFrame) -> DataFrame:
    """Index table of ``entries`` (key and ``FIELDS``), one row per bucket."""
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    dealt = entries.withColumn("buckets", F.lit(buckets)).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        hashed = key_hash(table["key"].to_numpy())
        levels = build_levels(hashed)
        order = np.argsort(number_of(hashed, levels))
        return pa.table(
            {
                "bucket": table["bucket"][:1],
                "buckets": table["buckets"][:1],
                "sizes": pa.array([[len(bits) for bits in levels]], pa.list_(pa.int32())),
                "bits": pa.array([[np.packbits(bits).tobytes() for bits in levels]], pa.list_(pa.binary())),
                "fingerprints": pa.array([fingerprint(hashed)[order]], pa.list_(pa.int64())),
                **{name: pa.array([table[name].to_numpy()[order].astype(np.int64)], pa.list_(pa.int64())) for name in FIELDS},
            }
        )

    kinds = "bucket int, buckets int, sizes array<int>, bits array<binary>, fingerprints array<long>, " + ", ".join(f"{name} array<long>" for name in FIELDS)
    # A group is one bucket of hashed distinct keys: about BUCKET_KEYS slim rows.
    return dealt.groupBy("bucket").applyInArrow(build, kinds)


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key and ``FIELDS``) for each row of ``keys`` (key) that the index holds."""
    one = index.select("buckets").first()
    buckets = one["buckets"] if one else 1
    asked = keys.filter("key is not null").select("key", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"))
    kinds = "key long, " + ", ".join(f"{name} long" for name in FIELDS)

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        hashed, empty = key_hash(left["key"].to_numpy()), pa.table({name: pa.array([], pa.int64()) for name in ("key", *FIELDS)})
        if not len(hashed) or not right.num_rows:
            return empty
        row = right.slice(0, 1).to_pylist()[0]
        levels = [np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool) for bits, size in zip(row["bits"], row["sizes"], strict=True)]
        number = number_of(hashed, levels)
        good = number >= 0
        good[good] = np.array(row["fingerprints"], np.int64)[number[good]] == fingerprint(hashed[good])
        number = number[good]
        return pa.table({"key": left["key"].to_numpy()[good], **{name: np.array(row[name], np.int64)[number] for name in FIELDS}})

    # Repeats of a key are asked once, so a group is at most one bucket's keys and those never stored.
    return asked.distinct().groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, kinds)


# --- Writing and reading a store ---------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, folder: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode the texts of ``docs`` with the tokenizer file ``path`` (same place on every worker) into ``folder``.

    Returns what ``documents`` reads from the files written, with ``at``, the first id of each row.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    shards = max(1, -(-slim.count() // SHARD_ROWS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([end_id], f"<u{own.width}").tobytes()
        shard, block, keys, counts, ids, size = None, 0, [], [], [], 0

        def out() -> pa.RecordBatch:
            data = pack_block(own.width, counts, ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(keys)], pa.int32()), pa.array([keys], pa.list_(pa.int64())), pa.array([data])],
                ["shard", "block", "rows", "keys", "data"],
            )

        for batch in batches:
            encoded_texts = (ids for b, e in common.slices(batch.column(2), TEXT_SLICE) for ids in own.encode(batch.column(2).slice(b, e - b)))
            for part, key, ids_of_text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoded_texts, strict=True):
                encoded = ids_of_text + end
                if keys and (part != shard or size + len(encoded) > BLOCK_BYTES):
                    yield out()
                    block, keys, counts, ids, size = block + 1 if part == shard else 0, [], [], [], 0
                shard = part
                keys.append(key)
                counts.append(len(encoded) // own.width)
                ids.append(encoded)
                size += len(encoded)
            common.give_back()
        if keys:
            yield out()

    # The further columns split the rows of a key that many rows share.
    order = [F.col("key").asc_nulls_first(), F.col("hash"), F.col("row")]
    slim = slim.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = slim.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    payload = ordered.select(F.spark_partition_id().alias("shard"), "key", "text").mapInArrow(run, PAYLOAD)
    payload.write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(f"{folder}/payload")

    rows = common.kept(documents(spark, folder), "rows")
    totals = rows.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("ids"))
    # One row per shard: slim however large the store.
    before = F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("ids")
    totals.withColumn("first", before).coalesce(1).write.parquet(f"{folder}/shards")
    base = spark.read.parquet(f"{folder}/shards").select("shard", "first")
    rows = rows.join(base, "shard").withColumn("at", F.col("first") + F.col("within"))
    placed = rows.select("key", "shard", "block", "place", F.col("at").alias("start"))
    first = placed.filter("key is not null").groupBy("key").agg(F.min(F.struct("start", "shard", "block", "place")).alias("at"), F.count("*").alias("rows"))
    first = common.kept(first, "firsts")
    build_index(first.select("key", "at.shard", "at.block", "at.place", "at.start", "rows")).write.parquet(f"{folder}/index")
    return rows


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, place, key, n_tokens, ids_crc32, within) of every document, read from the payload alone.

    ``within`` is the number of ids before it in its shard. The checksum is over little-endian 32-bit ids.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, keys, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, ids = unpack_block(data)
                ends = np.cumsum(counts, dtype=np.int64)
                wide = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(wide[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(keys, pa.int64())]
                    + [pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64())],
                    ["shard", "block", "place", "key", "n_tokens", "ids_crc32"],
                )

    payload = spark.read.schema(PAYLOAD).parquet(f"{folder}/payload").select("shard", "block", "keys", "data")
    rows = payload.mapInArrow(run, "shard int, block int, place int, key long, n_tokens long, ids_crc32 long")
    ahead = W.partitionBy("shard").orderBy("block", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("within", F.sum("n_tokens").over(ahead) - F.col("n_tokens"))


def read_keys(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(key, start, rows, ids array<int>) of the first row of each stored key of ``keys`` (key), through the index."""
    found = look_up(spark.read.parquet(f"{folder}/index"), keys)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for place, data in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                counts, ids = unpack_block(data)
                end = int(counts[: place + 1].sum(dtype=np.int64))
                out.append(ids[end - int(counts[place]) : end].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(out, pa.list_(pa.int32()))], ["key", "start", "rows", "ids"])

    payload = spark.read.schema(PAYLOAD).parquet(f"{folder}/payload").select("shard", "block", "data")
    spots = found.select("key", "start", "rows", "place", F.col("shard").cast("int").alias("shard"), F.col("block").cast("int").alias("block"))
    return payload.join(spots, ["shard", "block"]).select("key", "start", "rows", "place", "data").mapInArrow(cut, "key long, start long, rows long, ids array<int>")


def digests(docs: DataFrame, path: str, folder: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, read back from a new store in ``folder``.

    Every key is looked up in the index, and what lies at its place in the payload is checked against it.
    """
    spark = docs.sparkSession
    rows = write(docs, path, folder, id_col=id_col, text_col=text_col)
    found = look_up(spark.read.parquet(f"{folder}/index"), docs.select(F.col(id_col).cast("long").alias("key")))
    ids = found.select(F.col("key").alias("asked"), F.col("start").alias("from"), F.col("rows"))
    own = rows.join(ids, F.col("key") == F.col("asked"), "left")
    # Rows of one key lie one after the other from the place that the index gives.
    return own.filter("key is null or at >= from").select(F.col("key").alias("doc_id"), F.col("at").alias("start"), "n_tokens", "ids_crc32")
