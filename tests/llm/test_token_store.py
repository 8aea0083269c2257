"""Stores against the library's own ids, and index look-ups against a plain dictionary."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from plumbline.llm import piece_ids, token_store
from plumbline.llm.common import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def documents():
    random.seed(2)
    parts = ["the", "ing", " ", "  ", "\n", "é", "日本", "🙂", "123", "'s", "!!", "\t ", "\x85", "Word", "<|endoftext|>"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(200)]
    texts += [None, "", "a b " * 200_000]
    return [(7 * i + 3, t) for i, t in enumerate(texts)]


def test_read_back_equals_the_library(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_ROWS", 40)
    rows = documents()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(6)
    library, start = Tokenizer.from_file(PATH), 0
    got = {r["doc_id"]: r for r in token_store.digests(docs, PATH, shared_folder(spark, "store")).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (got[key]["start"], got[key]["n_tokens"], got[key]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_keyed_reads_and_strangers(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_ROWS", 3)
    docs = spark.createDataFrame([(i, f"text {i}") for i in (5, 1, 9, 1, 1, 30)] + [(None, "none")], "doc_id long, text string")
    folder = shared_folder(spark, "store")
    token_store.write(docs, PATH, folder)
    asked = spark.createDataFrame([(1,), (30,), (31,), (None,), (30,)], "key long")
    got = {r["key"]: (r["rows"], r["ids"]) for r in token_store.read_keys(spark, folder, asked).collect()}
    own = Tokenizer.from_file(PATH)
    assert got == {1: (3, own.encode("text 1").ids + [2]), 30: (1, own.encode("text 30").ids + [2])}
    assert sorted(r["start"] for r in token_store.digests(docs, PATH, shared_folder(spark, "store")).collect()) == [0, 2, 5, 8, 11, 14, 17]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.digests(docs, PATH, shared_folder(spark, "store")).collect() == []


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 50_000))
    hashed = token_store.key_hash(keys)
    levels = token_store.build_levels(hashed)
    assert sorted(token_store.number_of(hashed, levels).tolist()) == list(range(len(keys)))


def library_ids(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u2").tobytes()


def test_plain_words_pass_the_model_once_and_never_the_pattern_of_the_library():
    own, asked = token_store.Encoder(PATH), []
    expected = [library_ids(text) for text in ("the theatre, théâtre.\n\nthe", "theatre's  2 théâtre ", "")]
    model = own._pieces
    own._pieces = lambda pieces: asked.extend(pieces.to_pylist()) or model(pieces)
    own.library = None
    for _ in range(2):
        assert own.encode(pa.array(["the theatre, théâtre.\n\nthe", "theatre's  2 théâtre ", None])) == expected
    assert sorted(asked) == sorted({"the", " the", " theatre", ",", " théâtre", ".", "\n", "theatre", "'s", " ", " 2"})


def test_every_low_character_is_cut_as_the_library_cuts_it():
    own = token_store.Encoder(PATH)
    texts = [a + chr(c) + b for c in range(0x300) for a in ("", "a", "a ", "'", "1") for b in ("", "a", " b", "s", "\n", "  x")]
    for text, got in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert got == library_ids(text), ascii(text)


def test_a_full_table_of_words_changes_no_ids(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_BYTES", 300)
    own = token_store.Encoder(PATH)
    texts = [text for _, text in documents()[:-1]] * 2
    for begin in range(0, len(texts), 9):
        part = texts[begin : begin + 9]
        assert own.encode(pa.array(part, pa.string())) == [library_ids(text) for text in part]
    assert own.words.keys.nbytes < 2000
    assert own.encode(pa.array([], pa.string())) == []


def lengths(keys):
    return pc.binary_length(keys).to_numpy().astype("<u2"), np.ones(len(keys), np.int64)


def test_a_look_up_costs_what_is_asked_not_what_is_held():
    held = pa.array([f"word {i}" for i in range(300_000)])
    known, few = piece_ids.Known(1 << 30, "<u2"), held.slice(150_000, 10)
    known.look_up(held, lengths)

    def seconds(run):
        begin = time.process_time()
        for _ in range(20):
            run()
        return time.process_time() - begin

    assert 4 * seconds(lambda: known.look_up(few, lengths)) < seconds(lambda: pc.index_in(few, value_set=held))


def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch):
    monkeypatch.setattr(piece_ids, "string_hashes", lambda data, ends: (ends % 3).astype(np.uint64))
    test_a_full_table_of_words_changes_no_ids(monkeypatch)
    known = piece_ids.Known(1 << 20, "<u2")
    for asked in (["a", "bbb"], ["dddd", "bbb", "a"], ["", "bbb"]):
        assert known.look_up(pa.array(asked), lengths)[0].tolist() == [len(a) for a in asked]


def test_string_hashes_tell_strings_apart():
    words = ["", "a", "b", "ab", "ba", "a" * 5000, "a" * 5001, "é", "\0", "\0\0", *map(str, range(50_000))]
    hashes = piece_ids.string_hashes(*piece_ids.flat_bytes(pa.array(words)))
    assert len(set(hashes.tolist())) == len(words)
    assert piece_ids.string_hashes(*piece_ids.flat_bytes(pa.array(["x", *words]).slice(1))).tolist() == hashes.tolist()
    assert len(piece_ids.string_hashes(*piece_ids.flat_bytes(pa.array([], pa.string())))) == 0


def test_other_kinds_of_files_go_to_the_library_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = token_store.Encoder(path), Tokenizer.from_file(path)
    texts = ["The theatre, Théâtre.", "a  b\nc", ""]
    got = [np.frombuffer(ids, f"<u{own.width}").tolist() for ids in own.encode(pa.array(texts))]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
