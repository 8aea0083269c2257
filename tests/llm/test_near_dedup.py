"""Components against all pairs of a small table."""

from __future__ import annotations

import random
import re

import pytest

from plumbline.llm import near_dedup


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((top(a), top(b)))
                label[hi] = lo
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    words = [f"w{i}" for i in range(400)]
    out, text = [], lambda n: [random.choice(words) for _ in range(n)]
    for _ in range(12):  # chains and stars of copies with more and more edits
        base = text(random.choice([8, 30, 80, 200]))
        for _ in range(random.randint(1, 9)):
            copy = base.copy()
            for _ in range(random.randint(0, max(1, len(copy) // 18))):
                copy[random.randrange(len(copy))] = random.choice(words)
            out.append(" ".join(copy))
            base = copy if random.random() < 0.5 else base
    passage = " ".join(text(60))
    out += [passage + " " + " ".join(text(n)) for n in (4, 5, 6, 7, 10, 14, 16, 18, 20, 25, 30, 40)]
    out += ["", " \t\n", None, "one two", "ONE  two", "one two three four five", "É é ﬁ", "é é ﬁ", "a " * 50, "a " * 80, " ".join(text(30_000))]
    out += ["copy of the same text over and over"] * 30
    random.shuffle(out)
    return list(enumerate(out, 3))


def test_components_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, n long").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == plain(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (9, "A b c d e")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5, True), (5, 5, True), (9, 5, False), (None, None, True)]
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_components_equal_a_plain_search(spark):
    random.seed(11)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(1, 40)]
    label = {}

    def top(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in edges:
        if a != b:
            lo, hi = sorted((top(a), top(b)))
            label[hi] = lo
    got = {r["node"]: r["label"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: top(i) for i in label}
    assert near_dedup.components(spark.createDataFrame([(4, 4)], "a long, b long")).collect() == []


def test_what_an_explode_multiplies_is_joined_by_a_shuffle(spark, rows, monkeypatch):
    plans, kept = {}, near_dedup.common.kept

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, label)

    monkeypatch.setattr(near_dedup.common, "kept", noted)
    near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "SortMergeJoin [ak#" in plans["likely"]
    assert "SortMergeJoin [key#" in plans["members"] and "BroadcastHashJoin" not in plans["members"]
