"""Phrases against plain counting of every run of words, and the graph's own promises."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from plumbline.llm import collocations as co


def plain_counts(docs, longest):
    counts, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, n


def plain(docs, longest=3, least=10, inside=50, top=2000):
    counts, n = plain_counts(docs, longest)
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if 100 * a >= inside * candidates[part]:
                    dropped.add(part)
    rows = []
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            rows.append((lang, score, a, " ".join(words), counts[lang, words[:k]], counts[lang, words[k:]]))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[1], -r[2], r[3].encode()))[:top]
        out += [(lang, i, p, a, left, right, n[lang], s) for i, (_, s, a, p, left, right) in enumerate(mine, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    random.seed(5)
    words = [*"abcdefgh", "É", "é", "x y", "ß", "İ", "'", " ", "$1"]
    passage = " ".join(f"p{i}" for i in range(150))
    text = lambda n: "".join(random.choice(words) + random.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!?", " : "]) for _ in range(n))
    out = [(text(random.randint(0, 60)), random.choice(["en", "en", "de", None, ""])) for _ in range(250)]
    out += [(f"{text(3)} {passage} {text(2)}", "en") for _ in range(12)] + [(passage, "de")] * 11
    out += [("a b  c", "zh cn\tx"), (" a", "en"), ("a ", "en"), (" b ", "en")] * 4
    out += [("ha " * 40, "en"), (None, "fr"), ("", "fr"), (" ., \t", "fr"), ("The End " * 3000, "es"), ("one TWO", "es")]
    return out


def spark_docs(spark, docs):
    return spark.createDataFrame([(t, c, 1, "x", 2) for t, c in docs], "text string, lang string, n long, phrase string, rank long").repartition(6)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("longest, least, inside, top", [(3, 10, 50, 2000), (2, 3, 80, 7), (4, 2, 100, 60)])
def test_equals_plain_counting(spark, docs, longest, least, inside, top):
    assert rows(co.collocations(spark_docs(spark, docs), longest, least, inside, top)) == plain(docs, longest, least, inside, top)


def test_counts_follow_from_flow_and_ends(spark, docs):
    want, _ = plain_counts(docs, 4)
    for longest in (2, 3, 4):
        found = co.records(spark_docs(spark, docs), longest)
        got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in co.phrase_counts(found, longest).collect()}
        assert got == {p: f for p, f in want.items() if len(p[1]) <= longest}


def test_runs_are_shuffled_once_by_node(spark, docs):
    plan = co.phrase_counts(co.records(spark_docs(spark, docs)), 3, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") == 2
    windows, co.WINDOW_WORDS, co.GATHER_WORDS, co.SLICE_BYTES = (co.WINDOW_WORDS, co.GATHER_WORDS, co.SLICE_BYTES), 50, 7, 100
    try:
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in docs], "lang": ["und" if c is None else c for _, c in docs]}, pa.schema([("text", pa.string()), ("lang", pa.string())]))
        got = Counter()
        for part in co._count_runs([batch, batch.slice(0, 3)], 3):
            for entry, n in zip(part["entry"].to_pylist(), part["n"].to_pylist()):
                got[entry] += n
    finally:
        co.WINDOW_WORDS, co.GATHER_WORDS, co.SLICE_BYTES = windows
    want = Counter()
    for text, lang in [*docs, *docs[:3]]:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update(f"{' '.join(words[i : i + 3])}\t{'und' if lang is None else lang}" for i in range(len(words)))
    assert got == want


def test_paths_hold_every_edge_once(spark, docs):
    counts = co.phrase_counts(co.records(spark_docs(spark, docs)), 3, 10).cache()
    edges, nodes = counts.filter("words = 3").drop("words").cache(), counts.filter("words = 2").drop("words")
    unary = co.unary_nodes(edges, nodes)
    for stretch in (2, 64, 10**9):
        paths = co.compact(edges, unary, stretch=stretch).cache()
        assert sorted(map(tuple, co.expand(paths).collect())) == sorted(map(tuple, edges.collect()))
        if stretch == 10**9:  # the copied passage is one path, but for what differs before and behind it
            assert paths.agg({"n_edges": "max"}).first()[0] >= 140


def test_empty_table_and_parameters(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(none).collect() == []
    with pytest.raises(ValueError):
        co.collocations(none, longest=1)


def test_products_beyond_64_bits(spark, monkeypatch):
    entries = [("en", "a", "a b", 9_000_000_000), ("en", "a", "a", 1), ("en", "b", "b", 9_000_000_001)]
    monkeypatch.setattr(co, "records", lambda docs, longest: spark.createDataFrame(entries, "lang string, node string, run string, n long"))
    a, part = 9_000_000_000, 9_000_000_001
    assert [(r.score, r.l, r.r) for r in co.collocations(None, longest=2).collect()] == [(10**6 * a * a // (part * part), part, part)]
