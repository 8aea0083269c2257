"""Corpus pipeline over ``documents``: toxicity, near duplicates, benchmark leaks, personal data, token ids.

Every stage takes the rows that the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe_transducer, decontaminate, near_dedup, pii, toxicity
from plumbline.llm.common import kept, prepare, read
from plumbline.llm.queries import PATTERN, RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half. Labels that are held out are not learned from."""
    prepare(spark)
    labels = read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(model, docs, keep=tuple(docs.columns), name="__toxic")
    return scored.filter("__toxic < 0.5").drop("__toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id. Rows without id stay."""
    prepare(spark)
    verdicts = near_dedup.near_duplicates(docs)
    gone = verdicts.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited. A phrase of fewer than six words alone removes none."""
    prepare(spark)
    found = decontaminate.annotate(docs, read(spark, sf_dir, "benchmark"), name="__leaks")
    return found.filter(~F.exists("__leaks", lambda leak: leak["strong"])).drop("__leaks")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` counts the new text."""
    prepare(spark)
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents, ids decoded again."""
    prepare(spark)
    return bpe_transducer.digests(docs, RANKS, PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", redact_pii),
    ("bpe", encode),
]

#: No stage but the personal data could be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
