"""Leaks against an alignment of every document with every item."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from plumbline.llm import decontaminate


def plain_points(item, passage):
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if a == b else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.fixture(scope="module")
def data():
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(random.randint(15, 50)))) for i in range(12)] + [(90, "too short"), (91, None), (None, " ".join(text(20))), (3, " ".join(text(30)))]
    docs = []
    for i in range(60):
        _, source = items[i % 12]
        copy = source.split()
        for _ in range(i % 5 * len(copy) // 20):
            at = random.randrange(len(copy))
            copy[at : at + 1] = random.choice([[], [random.choice(vocabulary)], [copy[at], random.choice(vocabulary)]])
        docs.append(" ".join(text(40) + copy + text(30)).capitalize().replace(" w1", ",  W1"))
    docs += [" ".join(text(200)) for _ in range(20)] + [None, "", items[0][1] * 1, " ".join([items[1][1]] * 300), " ".join(text(20_000))]
    return list(enumerate(docs)), items


def test_alignment_equals_the_table():
    random.seed(1)
    for _ in range(200):
        a, b = (np.array([random.randrange(5) for _ in range(random.randint(1, 12))]) for _ in range(2))
        points, begin, end = decontaminate.align(a, b)
        assert points == plain_points(a.tolist(), b.tolist())
        assert not points or plain_points(a.tolist(), b[begin:end].tolist()) == points


def test_leaks_equal_all_alignments(spark, data):
    docs, items = data
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id long").repartition(3)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, text in docs:
        own = words(text)
        if len(own) > 3_000:
            continue
        for item, source in items:
            if item is not None and len(words(source)) >= 3:
                score = plain_points(words(source), own) / (2 * len(words(source)))
                if score >= decontaminate.LEAK:
                    want[i, item] = max(score, want.get((i, item), 0))
    long = {k for k in got if len(words(docs[k[0]][1])) > 3_000}
    assert long == {(83, 1)}
    assert {k: v for k, v in got.items() if k not in long} == want


def test_edits_at_regular_places_equal_all_alignments(spark):
    random.seed(8)
    vocabulary = [f"v{i}" for i in range(2_000)]
    text = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([3, 4, 5, 8, 16, 20, 35, 60])]
    docs = []
    for _, source in items:
        own = source.split()
        for step in (2, 3, 5):
            docs.append([w if i % step else "other" for i, w in enumerate(own)])  # every second, third, fifth word replaced
            docs.append([w for i, w in enumerate(own) if i % step])  # or left out
            docs.append([x for i, w in enumerate(own) for x in ([w] if (i + 1) % step else [w, "more"])])  # or one put in
        docs.append([x for w in own for x in (w, "more")])
        docs.append([w if random.random() < 0.6 else "other" for w in own])
    docs = list(enumerate(" ".join(text(90) + copy + text(70)) for copy in docs)) + [(1000, items[7][1])] * 4
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, t in docs:
        for item, source in items:
            n, points = len(words(source)), plain_points(words(source), words(t))
            if points >= max(0.4 * 2 * n, 2 * min(n, 6)):
                want[i, item] = points / (2 * n)
    assert len(want) > 40 and got == want
    assert len({item for _, item in want}) >= 5


def test_short_long_and_spaceless_items(spark):
    random.seed(9)
    text = lambda n: [f"u{random.randrange(3_000)}" for _ in range(n)]
    long = text(130)
    items = [(1, "東京の首都はどこですか"), (2, "ประเทศไทยมีกี่จังหวัด"), (3, "blue whale"), (4, "ytterbium"), (None, " ".join(text(20))), (5, " ".join(long)), (6, "  ")]
    around = lambda x: " ".join([*text(60), x, *text(50)])
    docs = [items[0][1], "これは" + items[0][1] + "問題", around(items[1][1]), around("The Blue, whale"), around("blue old whale"), around("Ytterbium"), around(items[4][1]), around(" ".join(long[40:90])), around(" ".join(long[40:60])), "東西南北", ""]
    found = decontaminate.leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["end_word"], r["score"]) for r in found}
    assert got == {(0, 1): (0, 11, 1.0), (1, 1): (3, 14, 1.0), (2, 2): (60, 81, 1.0), (3, 3): (61, 63, 1.0), (5, 4): (60, 61, 1.0), (6, None): (60, 80, 1.0), (7, 5): (60, 110, 100 / 260)}


def test_common_words_are_no_leak(spark):
    items = [(1, "What is the capital?"), (2, "yes"), (3, "What is the name of the largest river in the country?"), (4, "Name the five oldest towns")]
    docs = ["I wonder what is going on in town today", "oh yes we did", "what is the name of the game", "so: what is the CAPITAL, then", "Tell me what is the name of the largest lake", "name the five oldest"]
    found = decontaminate.leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["strong"] for r in found}
    assert got == {(1, 2): False, (2, 3): True, (3, 1): False, (4, 3): True}


def test_annotate_keeps_columns_and_empty_tables(spark, data):
    docs = spark.createDataFrame([(1, "x", [2])], "doc_id long, text string, start array<int>")
    items = spark.createDataFrame(data[1], "item_id long, text string")
    assert decontaminate.annotate(docs, items).collect() == [(1, "x", [2], [])]
    assert decontaminate.annotate(docs.limit(0), items).collect() == []
    assert decontaminate.leaks(docs, items.limit(0)).collect() == []
