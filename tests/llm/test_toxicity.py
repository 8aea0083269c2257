"""Held-out accuracy, calibration and rows of every kind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.llm import common, toxicity

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    labels = common.read(spark, SAMPLE, "labels")
    return toxicity.fit(common.read(spark, SAMPLE, "documents"), labels.filter(~toxicity.held_out(F.col("doc_id"))))


def test_held_out_labels_are_met_and_chances_are_true(spark, model):
    labels = common.read(spark, SAMPLE, "labels").filter(toxicity.held_out(F.col("doc_id")))
    rows = toxicity.score(model, common.read(spark, SAMPLE, "documents")).join(labels, "doc_id").collect()
    assert len(rows) > 20 and {r["toxic"] for r in rows} == {0, 1}
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in rows) / len(rows) >= 0.9
    assert abs(sum(r["score"] for r in rows) - sum(r["toxic"] for r in rows)) / len(rows) <= 0.1


def test_clashing_names_nulls_long_and_repeated_rows(spark, model):
    names = ["doc_id", "text", "score", "hits", "features", "raw", "vector", "prediction", "a b", "kept_0", "tick`s"]
    texts = [None, "", "plain words of a quiet day", "plain words of a quiet day", "you are " * 100_000, "!!!", " \n "]
    docs = spark.createDataFrame([(i if i else None, t, *range(i, i + 9)) for i, t in enumerate(texts)], ["doc_id", "text", *(f"c{i}" for i in range(9))])
    docs = docs.toDF(*names)
    got = toxicity.score(model, docs, keep=tuple(names), name="__toxic")
    assert got.columns == [*names, "__toxic"]
    rows = got.collect()
    assert sorted(tuple(r)[:-1] for r in rows if r[0]) == sorted(tuple(r) for r in docs.collect() if r[0])
    assert all(0 <= r[-1] <= 1 for r in rows)
    of = {r["doc_id"]: r[-1] for r in rows}
    assert len(rows) == len(texts) and of[2] == of[3] and of[None] == of[1]
    assert toxicity.score(model, docs.limit(0), keep=tuple(names), name="s").collect() == []
