"""Encoding against the tiktoken library, decoding against the bytes that went in."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from plumbline.llm import bpe_transducer as bpe
from plumbline.llm.queries import PATTERN, RANKS

ODD = "a b  c\n\n d\t\x0b\x1c\x85\xa0 ‍.,!?'s'LL 012٣é́ß漢字かな🙂👩‍👩‍👧\U0010fffd퟿<|endoftext|>".split(" ")


def hard_texts(n: int) -> list[str]:
    random.seed(n)
    letters = [c for part in ODD for c in part] + list(" \n") * 4 + list("etaoinshr") * 3
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(n)]
    return texts + ["", " ", "  ", " a", "a ", "\n", "x" * 5000, "ab" * 700 + " " + "é" * 900, " " * 400, "don't  stop \n now", *ODD]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("any", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_equals_the_library_alone_together_and_after_restarts(library):
    texts = hard_texts(1500)
    want = [np.array(library.encode_ordinary(text), "<u4").tobytes() for text in texts]
    own = bpe.Codec(bpe.load_ranks(RANKS), PATTERN)
    assert own.encode_many(texts) == want
    own.forget()
    assert [own.encode(text) for text in texts[::7]] == want[::7]
    own.machine.most_states = 50  # starts anew for almost every call
    own.forget()
    assert [own.encode(text) for text in texts[::7]] == want[::7]
    assert len(own.machine.states) < 20_000
    assert own.encode_many([]) == []


def test_words_together_equal_words_alone():
    machine = bpe.Transducer(bpe.load_ranks(RANKS))
    words = [b"", b" merging", b"\xff\xfe\x00", b"aaaaaaaaaaaaaaaaa", "漢字かな".encode(), b"", b" the", b"q" * 300]
    counts, ids = machine.encode_words(b"".join(words), np.array([len(w) for w in words]))
    alone = [machine.encode(word) for word in words]
    assert counts.tolist() == [len(a) for a in alone]
    assert ids.tolist() == sum(alone, [])


def test_stream_of_bytes_cut_anywhere():
    random.seed(4)
    for text in hard_texts(60):
        data, stream, out, at = text.encode(), bpe.Utf8Stream(), "", 0
        while at < len(data):
            n = random.randint(1, 4)
            out, at = out + stream.feed(data[at : at + n]), at + n
        assert out + stream.end() == text


@pytest.mark.parametrize("data", [b"\xe2\x82", b"a\xc0\xafb", b"\xed\xa0\x80", b"\xf4\x90\x80\x80z", b"\x80\x80\x80\x80\x80", b"ok\xf0\x9f", b"\xe0\x80\x80", b"\xf0\x9f\x99\x82\xff"])
def test_stream_of_bytes_that_are_no_utf8(data):
    for cut in range(len(data) + 1):
        stream = bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.end() == data.decode("utf-8", "replace")


def test_table_of_states_takes_what_is_utf8():
    for lead in (0x41, 0xC1, 0xC2, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF3, 0xF4, 0xF5):
        for second in range(0, 256, 5):
            data = bytes([lead, second, 0x80, 0x80])[: 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)]
            state = 0
            for byte in data:
                state = int(bpe.UTF8[state, byte])
            try:
                data.decode()
                assert state == 0
            except UnicodeDecodeError:
                assert state == 8


def test_digests_of_a_table(spark, library):
    rows = [(i, text) for i, text in enumerate(hard_texts(40))] + [(None, "null id"), (7, None), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, ids int, `a b` string").repartition(3)
    got = sorted(map(tuple, bpe.digests(docs, RANKS, PATTERN).collect()), key=str)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    ids = [(i, t or "", library.encode_ordinary(t or "")) for i, t in rows]
    assert got == sorted([(i, len(n), sha(np.array(n, "<u4").tobytes()), sha(t.encode())) for i, t, n in ids], key=str)
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted([(r["doc_id"], r["text"], r["n_bytes"]) for r in back], key=str) == sorted([(i, t, len(t.encode())) for i, t, _ in ids], key=str)
    assert bpe.digests(docs.limit(0), RANKS, PATTERN).collect() == []


def test_a_piece_passes_the_machine_once_whatever_stands_around_it(library):
    own, asked = bpe.Codec(bpe.load_ranks(RANKS), PATTERN), []
    texts = ["the theatre, théâtre.\n\nthe", "theatre's  2 théâtre ", "(théâtre) théâtre! theatre?\tthe", ""]
    through = own.machine.encode_words

    def watched(data, lengths):
        ends = np.cumsum(lengths).tolist()
        asked.extend(bytes(data)[begin:end].decode() for begin, end in zip([0, *ends], ends))
        return through(data, lengths)

    own.machine.encode_words = watched
    for _ in range(2):
        assert own.encode_many(texts) == [np.array(library.encode_ordinary(text), "<u4").tobytes() for text in texts]
    # Words are looked up as they are behind a space, also the first of a text.
    assert sorted(asked) == sorted({piece for text in texts for piece in own.split.findall(text) + own.split.findall(" " + text)})


def test_full_tables_change_no_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 300)
    monkeypatch.setattr(bpe, "PIECE_BYTES", 20)
    texts = hard_texts(300)
    own = bpe.Codec(bpe.load_ranks(RANKS), PATTERN)
    own.machine.most_states = 300
    for begin in range(0, len(texts), 40):
        part = texts[begin : begin + 40]
        assert own.encode_many(part) == [np.array(library.encode_ordinary(text), "<u4").tobytes() for text in part]
    assert own.words.keys.nbytes < 2000


def test_waiting_long_words_outlive_a_restart():
    ranks = bpe.load_ranks(RANKS)
    random.seed(8)
    words = ["".join(random.choices("etaoinshr", k=k)).encode() for k in (300, 200, 250)]
    want = [bpe.Transducer(ranks).encode(word) for word in words]
    ids = bpe.Transducer(ranks, most_states=20).encode_words(b"".join(words), np.array([len(w) for w in words]))[1]
    assert ids.tolist() == sum(want, [])
