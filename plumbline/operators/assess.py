"""Scoring of stage-2 reviews: reuse earlier scores, pick what is left, call the
scorer, clean its output, count."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from plumbline.constants import (
    LINGUISTIC_STYLES,
    MAX_ATTEMPTS,
    SIGNAL_CODES,
    UNLISTED_TEMPLATE,
)
from plumbline.functions.scoring import classify_error, is_retryable, token_cost
from plumbline.functions.text import cut_utf16, strict_json, utf16_units
from plumbline.schemas import ASSESSMENTS
from plumbline.session import durable

RUN = "pipeline_run_id"
_COPIED = [
    "shill_score",
    "template_detected",
    "template_id",
    "template_name",
    "linguistic_style",
    "detected_signals",
    "rationale_short",
    "model_id",
    "prompt_version",
    "input_tokens",
    "output_tokens",
    "signal_span_mismatch_count",
]


def _stage2_with_hash(stage2: DataFrame, raw: DataFrame, run_id: str) -> DataFrame:
    mine = stage2.where(F.col(RUN) == run_id)
    return mine.join(raw.select("review_id", "content_hash"), "review_id")


# -- reuse -------------------------------------------------------------------


def copy_forward_candidates(
    stage2: DataFrame, raw: DataFrame, earlier: DataFrame, run_id: str, model: str, prompt: str
) -> DataFrame:
    """The newest score another run gave the same text with the same model and
    prompt, restated for this run: place and hash are current, scores are old.
    The newest is reduced per review, without sorting its history."""
    usable = earlier.where(
        (F.col("model_id") == model) & (F.col("prompt_version") == prompt) & (F.col(RUN) != run_id)
    ).select("review_id", "content_hash", F.struct("assessed_at", RUN, *_COPIED).alias("old"))
    current = _stage2_with_hash(stage2, raw, run_id).select("review_id", "store_id", "product_id", "content_hash")
    newest = (
        current.join(usable, ["review_id", "content_hash"])
        .groupBy("review_id")
        .agg(
            F.max_by(
                F.struct("store_id", "product_id", "content_hash", "old"), F.struct("old.assessed_at", f"old.{RUN}")
            ).alias("c")
        )
    )
    columns = {
        "review_id": F.col("review_id"),
        RUN: F.lit(run_id),
        "store_id": F.col("c.store_id"),
        "product_id": F.col("c.product_id"),
        "content_hash": F.col("c.content_hash"),
        "score_source": F.lit("copied"),
        "assessed_at": F.current_timestamp(),
        **{name: F.col(f"c.old.{name}") for name in _COPIED},
    }
    return newest.select(*[columns[c].alias(c) for c in ASSESSMENTS.names if c in columns])


def count_copy_skips(
    stage2: DataFrame, raw: DataFrame, earlier: DataFrame, run_id: str, model: str, prompt: str
) -> DataFrame:
    """Reviews whose text was scored before, but only by another model or prompt."""
    current = _stage2_with_hash(stage2, raw, run_id).select("review_id", "content_hash")
    others = earlier.where(F.col(RUN) != run_id)
    same = (F.col("model_id") == model) & (F.col("prompt_version") == prompt)
    keys = ["review_id", "content_hash"]
    return (
        current.join(others.where(~same).select(*keys), keys, "left_semi")
        .join(others.where(same).select(*keys), keys, "left_anti")
        .agg(F.count("*").alias("n"))
    )


def select_pending(
    stage2: DataFrame, raw: DataFrame, scored: DataFrame, errors: DataFrame, run_id: str, force: bool = False
) -> DataFrame:
    """Stage-2 reviews of a run still to score. ``force`` ignores what is scored or
    has failed for good."""
    pending = _stage2_with_hash(stage2, raw, run_id)
    if not force:
        of_run = lambda df: df.where(F.col(RUN) == run_id)
        final = of_run(errors).where(~F.col("retryable"))
        pending = pending.join(of_run(scored).select("review_id"), "review_id", "left_anti").join(
            final.select("review_id"), "review_id", "left_anti"
        )
    return pending.select(
        "review_id",
        "comment_text",
        "store_id",
        "product_id",
        "matched_seed_id",
        "matched_seed_category",
        "content_hash",
    )


# -- scorer output -----------------------------------------------------------


def _kind(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node), F.lit("MISSING"))


def _node(doc: Column, key: str) -> Column:
    return F.variant_get(doc, f"$.{key}", "variant")


def _string(doc: Column, key: str) -> Column:
    return F.when(_kind(_node(doc, key)) == "STRING", F.try_variant_get(doc, f"$.{key}", "string"))


def _number(doc: Column, key: str) -> Column:
    numeric = _kind(_node(doc, key)).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(numeric, F.try_variant_get(doc, f"$.{key}", "double"))


_DECIMAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_HEX = "^0[xX][0-9a-fA-F]{1,15}$"


def _score(doc: Column) -> Column:
    """Score as a number: numeric texts, booleans and null (0) are accepted. Texts
    are decimal or hexadecimal; suffixes such as in "75d" are no numbers."""
    kind = _kind(_node(doc, "shill_score"))
    text = F.trim(_string(doc, "shill_score"))
    value = (
        F.when(kind == "STRING", F.when(text == "", 0.0).when(text.rlike(_DECIMAL), text.try_cast("double")).when(text.rlike(_HEX), F.conv(F.substr(text, F.lit(3)), 16, 10).try_cast("double")))
        .when(kind == "VOID", 0.0)
        .when(kind == "BOOLEAN", F.try_variant_get(doc, "$.shill_score", "boolean").cast("int").cast("double"))
        .otherwise(_number(doc, "shill_score"))
    )
    return F.when(value.between(0, 100), F.floor(value + 0.5).cast("long"))


def _signals(doc: Column, text: Column, max_signals: int | None, max_span_units: int | None) -> tuple[Column, Column]:
    """Usable signals and the number of spans that the text does not contain.
    With ``max_signals`` reading stops once there are that many."""
    node = _node(doc, "detected_signals")
    items = F.when(_kind(node).startswith("ARRAY"), node.cast("array<variant>"))
    items = F.filter(F.coalesce(items, F.array().cast("array<variant>")), lambda v: _kind(v).startswith("OBJECT"))
    read = F.transform(
        items,
        lambda v: F.struct(
            _string(v, "code").alias("code"),
            _string(v, "span").alias("span"),
            _number(v, "start_char").alias("start"),
            _number(v, "end_char").alias("end"),
        ),
    )
    known = F.filter(
        read,
        lambda s: F.coalesce(
            s["code"].isin(SIGNAL_CODES)
            & (F.length(s["span"]) > 0)
            & (F.lit(True) if max_span_units is None else utf16_units(s["span"]) <= max_span_units),
            F.lit(False),
        ),
    )
    found = F.filter(known, lambda s: F.contains(text, s["span"]))

    def count(seen: Column, s: Column) -> Column:
        hit = F.contains(text, s["span"])
        missed = ~hit if max_signals is None else ~hit & (seen["hits"] < max_signals)
        return F.struct(
            (seen["hits"] + hit.cast("long")).alias("hits"),
            (seen["misses"] + missed.cast("long")).alias("misses"),
        )

    zero = F.struct(F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("misses"))
    mismatches = F.aggregate(known, zero, count, lambda seen: seen["misses"])

    def clean(s: Column) -> Column:
        start, end = s["start"], s["end"]
        whole = (start == F.floor(start)) & (end == F.floor(end)) & (start >= 0) & (start < end)
        slice_ = F.substring(text, F.coalesce(start, F.lit(0)).cast("int") + 1, F.coalesce(end - start, F.lit(0)).cast("int"))
        exact = F.coalesce(whole & (end <= F.char_length(text)) & (slice_ == s["span"]), F.lit(False))
        return F.struct(
            s["code"].alias("code"),
            s["span"].alias("span"),
            F.when(exact, start.cast("int")).alias("start_char"),
            F.when(exact, end.cast("int")).alias("end_char"),
        )

    return F.transform(found if max_signals is None else F.slice(found, 1, max_signals), clean), mismatches


def sanitize_scores(
    df: DataFrame,
    allowed_templates: list[str],
    payload: str = "payload",
    max_signals: int | None = None,
    max_span_units: int | None = None,
    max_rationale_units: int | None = None,
) -> DataFrame:
    """``df(comment_text, payload, …)`` plus the cleaned assessment columns and
    ``schema_error``, which is NULL where the payload is usable. Everything usable
    is kept unless the caller passes a limit (in UTF-16 units for texts)."""
    doc, text = F.col("doc"), F.col("comment_text")
    flag_kind = _kind(_node(doc, "template_detected"))
    detected = F.when(flag_kind == "BOOLEAN", F.try_variant_get(doc, "$.template_detected", "boolean"))
    template = _string(doc, "template_id")
    listed = template.isin([*allowed_templates, UNLISTED_TEMPLATE])
    style = _string(doc, "linguistic_style")
    rationale = _string(doc, "rationale_short")
    signals, mismatches = _signals(doc, text, max_signals, max_span_units)
    score = _score(doc)

    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    wrong = F.concat_ws(
        ", ",
        F.when(score.isNull(), "shill_score"),
        F.when(detected.isNull(), "template_detected"),
        F.when(~F.coalesce(style.isin(LINGUISTIC_STYLES), F.lit(False)), "linguistic_style"),
        F.when(rationale.isNull(), "rationale_short"),
    )
    error = F.when(~is_object, "assessment JSON is not an object").when(
        wrong != "", F.concat(F.lit("missing or invalid: "), wrong)
    )
    return (
        df.withColumn("doc", strict_json(F.col(payload)))
        .withColumn("schema_error", error)
        .withColumns(
            {
                "shill_score": score,
                "template_detected": detected,
                "template_id": F.when(
                    detected & (F.length(template) > 0), F.when(listed, template).otherwise(UNLISTED_TEMPLATE)
                ),
                "template_name": F.when(detected, _string(doc, "template_name")),
                "linguistic_style": style,
                "detected_signals": signals,
                "rationale_short": rationale if max_rationale_units is None else cut_utf16(rationale, max_rationale_units),
                "signal_span_mismatch_count": mismatches,
            }
        )
        .drop("doc")
    )


# -- scoring -----------------------------------------------------------------

# A scorer takes a pandas frame of pending rows and returns, row for row,
# payload (JSON text), input_tokens, output_tokens, thought_tokens, and for a
# failed call http_status, error_kind, error_message and, if known, retry_after.
Scorer = Callable[[pd.DataFrame], pd.DataFrame]
_CALL = StructType(
    [
        StructField("payload", StringType()),
        StructField("input_tokens", LongType()),
        StructField("output_tokens", LongType()),
        StructField("thought_tokens", LongType()),
        StructField("http_status", LongType()),
        StructField("error_kind", StringType()),
        StructField("error_message", StringType()),
        StructField("attempt_count", LongType()),
    ]
)


def retry_delay(attempt: int, retry_after: float | None, jitter: Callable[[], float] = random.random) -> float:
    """Seconds to wait after failed attempt ``attempt`` (from 0): what the service asks for, else doubling."""
    return retry_after if retry_after is not None else min(30.0, 0.5 * 2**attempt) + 0.25 * jitter()


def with_retry(
    scorer: Scorer, attempts: int = MAX_ATTEMPTS, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random
) -> Scorer:
    """``scorer``, called again for the rows of a batch that failed for a passing reason, ``attempts`` times at most.
    Answers gain ``attempt_count``; a scorer may say ``retry_after`` in seconds, the longest of a batch counts."""
    columns = [*_CALL.names, "retry_after"]

    def passing(answer: pd.Series) -> bool:
        text = lambda name: None if pd.isna(answer[name]) else str(answer[name])
        status = None if pd.isna(answer["http_status"]) else int(answer["http_status"])
        return pd.isna(answer["payload"]) and is_retryable(status, text("error_message"), text("error_kind"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        answers = scorer(rows).reset_index(drop=True).reindex(columns=columns).astype(object)
        answers["attempt_count"] = 1
        for attempt in range(attempts - 1):
            again = [i for i in range(len(answers)) if passing(answers.iloc[i])]
            if not again:
                break
            asked = [float(v) for v in answers.loc[again, "retry_after"] if not pd.isna(v)]
            sleep(retry_delay(attempt, max(asked) if asked else None, jitter))
            fresh = scorer(rows.iloc[again].reset_index(drop=True)).reset_index(drop=True).reindex(columns=columns).astype(object)
            fresh["attempt_count"] = attempt + 2
            fresh.index = again
            answers.loc[again] = fresh
        return answers

    return run


def call_scorer(pending: DataFrame, scorer: Scorer, partitions: int | None = None) -> DataFrame:
    """``pending`` plus the scorer's answer columns. A partition has one call in
    flight; ``partitions`` bounds their number."""
    kinds = {f.name: pa.int64() if f.dataType == LongType() else pa.string() for f in _CALL.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                answers = scorer(batch.to_pandas()).reindex(columns=_CALL.names)
                columns = [
                    pa.array([None if pd.isna(v) else v for v in answers[name]], kind) for name, kind in kinds.items()
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *kinds])

    dealt = pending if partitions is None else pending.repartition(partitions)
    return dealt.mapInArrow(run, StructType(pending.schema.fields + _CALL.fields))


class OverBudget(RuntimeError):
    """More reviews to score than one run may; nothing was called."""


def score_pending(
    pending: DataFrame,
    scorer: Scorer,
    run_id: str,
    model: str,
    prompt: str,
    allowed_templates: list[str],
    limit: int | None = None,
    max_rows: int | None = None,
    source: str = "scored",
    attempts: int = MAX_ATTEMPTS,
    sleep: Callable[[float], None] = time.sleep,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assessments, errors and run counters of one scoring run.

    ``limit`` is the caller's own row budget; above ``max_rows``, if given, the run
    stops before the first call. Answers are made durable before they are used twice,
    so a lost executor does not repeat paid calls.
    """
    chosen = pending if limit is None else pending.orderBy("review_id").limit(limit)
    if max_rows is not None and chosen.limit(max_rows + 1).count() > max_rows:
        raise OverBudget(f"more than {max_rows} reviews to score")
    answers = durable(call_scorer(chosen, with_retry(scorer, attempts, sleep), partitions))
    failed = F.col("payload").isNull()
    clean = sanitize_scores(answers.where(~failed), allowed_templates)
    assessments = clean.where("schema_error IS NULL").select(
        *[
            {
                RUN: F.lit(run_id),
                "model_id": F.lit(model),
                "prompt_version": F.lit(prompt),
                "score_source": F.lit(source),
                "assessed_at": F.current_timestamp(),
            }.get(c, F.col(c)).alias(c)
            for c in ASSESSMENTS.names
        ]
    )
    outcome = classify_error(F.col("http_status"), F.col("error_message"), F.col("error_kind"))
    thrown = answers.where(failed).withColumn("o", outcome)

    def error_row(error_class: Column, message: Column, retryable: Column, status: Column) -> list[Column]:
        return [
            F.col("review_id"),
            F.lit(run_id).alias(RUN),
            F.coalesce("attempt_count", F.lit(1)).cast("long").alias("attempt_count"),
            status.cast("long").alias("http_status"),
            error_class.alias("error_class"),
            message.alias("error_message"),
            retryable.alias("retryable"),
            F.current_timestamp().alias("failed_at"),
        ]

    errors = clean.where("schema_error IS NOT NULL").select(
        *error_row(F.lit("schema"), F.col("schema_error"), F.lit(False), F.lit(None))
    ).unionByName(
        thrown.select(
            *error_row(F.col("o.error_class"), F.col("error_message"), F.col("o.retryable"), F.col("o.http_status"))
        )
    )
    graded = clean.select("input_tokens", "output_tokens", "thought_tokens", "schema_error", "signal_span_mismatch_count").unionByName(
        answers.where(failed).select(
            "input_tokens",
            "output_tokens",
            "thought_tokens",
            F.lit("call failed").alias("schema_error"),
            F.lit(0).cast("long").alias("signal_span_mismatch_count"),
        ).withColumn("called", F.lit(False)),
        allowMissingColumns=True,
    ).withColumn("called", F.coalesce("called", F.lit(True)))
    return assessments, errors, score_counters(graded, model)


def score_counters(results: DataFrame, model: str) -> DataFrame:
    """One row: attempts, errors and their rate, span mismatches, and estimated
    cost. The cost is unknown (NULL) when nothing was answered, when any answer
    has no price, or when the model billed hidden reasoning tokens.

    ``results`` has ``called, schema_error, signal_span_mismatch_count`` and the
    three token columns.
    """
    called = F.col("called")
    tokens = lambda c: F.coalesce(F.col(c), F.lit(0))
    cost = F.when(called, token_cost(F.lit(model), tokens("input_tokens"), tokens("output_tokens")))
    thought = F.coalesce(F.col("thought_tokens") > 0, F.lit(False)) & called
    failed = F.col("schema_error").isNotNull()
    counts = results.agg(
        F.count("*").alias("n_attempted"),
        F.count_if(~failed).alias("n_scored"),
        F.count_if(failed).alias("n_errors"),
        F.coalesce(F.sum(F.when(~failed, F.col("signal_span_mismatch_count"))), F.lit(0)).alias("signal_span_mismatch_total"),
        F.coalesce(F.bool_or(thought), F.lit(False)).alias("thinking_not_off"),
        F.sum(cost).alias("cost_sum"),
        F.count_if(called & cost.isNull()).alias("n_unpriced"),
    )
    known = ~F.col("thinking_not_off") & (F.col("n_unpriced") == 0)
    return counts.select(
        "n_attempted",
        "n_scored",
        "n_errors",
        F.coalesce(F.try_divide("n_errors", "n_attempted"), F.lit(0.0)).alias("error_rate"),
        "signal_span_mismatch_total",
        "thinking_not_off",
        F.when(known, F.col("cost_sum")).alias("cost_usd_est"),
    )
