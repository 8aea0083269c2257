"""The pipeline's decisions, stage by stage, on the synthetic documents and on rows of hard kinds."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from plumbline.llm import bpe_transducer, decontaminate, near_dedup, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_what_operators_allow(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        after = corpus_pipeline.kept(stage(spark, docs, FOLDER), name)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        left = {r["doc_id"] for r in after.collect()}
        if name == "near_dedup":
            assert left == {r["doc_id"] for r in near_dedup.near_duplicates(docs).collect() if r["kept"]}
        if name == "decontamination":
            assert left == set(before) - {r["doc_id"] for r in decontaminate.leaks(docs, benchmark).collect()}
        if name == "pii":
            assert left == set(before)
        docs = after
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_transducer.load_ranks(corpus_pipeline.RANKS), special_tokens={})
    out = corpus_pipeline.encode(spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in out} == set(texts) and len(out) < 200
    for r in out:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_hard_rows_pass_all_stages(spark):
    kinds = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "same text of a few words only", None, None, None)]
    rows += [(3, "same text of a few words only", "en", "s", 1), (4, "long " * 100_000, "en", "s", 1), (5, "mail me at a@b.org", "en", "s", 1)]
    docs = spark.createDataFrame(rows, kinds)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.kept(stage(spark, docs, FOLDER), "hard")
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == [1, 1, 2, 4, 5, None]
    empty = spark.createDataFrame([], kinds)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.kept(stage(spark, empty, FOLDER), "empty")
    assert empty.count() == 0


def test_near_duplicates_broadcast_no_table_keys(spark, monkeypatch):
    plans, kept = {}, near_dedup.common.kept

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, label)

    monkeypatch.setattr(near_dedup.common, "kept", noted)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, FOLDER)
    assert "Generate" in plans["members"] and "BroadcastExchange" not in plans["members"]


def test_without_labels_the_lexicon_decides(spark):
    docs = spark.createDataFrame([(1, "you are an idiot and a moron"), (2, "a kind word"), (None, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.verdicts(docs, labels).collect()}
    import pytest

    assert got == {1: (pytest.approx(2 / 3), 1), 2: (0.0, 0), None: (0.0, 0), 3: (0.0, 0)}
