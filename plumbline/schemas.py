"""Column layout of every stored table."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_S, _L, _D, _B, _T = StringType(), LongType(), DoubleType(), BooleanType(), TimestampType()


def _table(*columns: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


SIGNALS = ArrayType(
    _table(("code", _S), ("span", _S), ("start_char", IntegerType()), ("end_char", IntegerType()))
)

RAW_REVIEWS = _table(
    ("review_id", _S),
    ("marketplace", _S),
    ("native_review_id", _S),
    ("store_id", _S),
    ("product_id", _S),
    ("reviewer_id_hash", _S),
    ("star_rating", _L),
    ("comment_text", _S),
    ("content_hash", _S),
    ("review_ts", _T),
    ("ingested_at", _T),
    ("crawl_batch_id", _S),
    ("pipeline_run_id", _S),
    ("source_url_hash", _S),
    ("language_hint", _S),
    ("has_media", _B),
    ("raw_payload_hash", _S),
    ("char_length", _L),
    ("updated_at", _T),
)

# Columns a changed review takes from the new batch; identity columns never move.
REWRITTEN_COLUMNS = [
    "comment_text",
    "content_hash",
    "char_length",
    "star_rating",
    "review_ts",
    "language_hint",
    "has_media",
    "raw_payload_hash",
    "crawl_batch_id",
    "pipeline_run_id",
    "ingested_at",
    "updated_at",
]

PHRASES = _table(
    ("phrase_id", _S),
    ("phrase", _S),
    ("match_type", _S),
    ("lang", _S),
    ("category", _S),
    ("is_active", _B),
    ("phrase_version", _S),
)

SEEDS = _table(
    ("seed_id", _S),
    ("category", _S),
    ("seed_text", _S),
    ("seed_version", _S),
    ("is_active", _B),
    ("created_at", _T),
)

REVIEW_VECTORS = _table(
    ("pipeline_run_id", _S),
    ("review_id", _S),
    ("store_id", _S),
    ("product_id", _S),
    ("content_hash", _S),
    ("embedding", ArrayType(_D, False)),
    ("embedding_model", _S),
    ("task_type", _S),
    ("status", _S),
    ("status_detail", _S),
    ("embedded_at", _T),
)

SEED_VECTORS = _table(
    ("seed_version", _S),
    ("seed_id", _S),
    ("category", _S),
    ("embedding", ArrayType(_D, False)),
    ("embedding_model", _S),
    ("embedded_at", _T),
)

ASSESSMENTS = _table(
    ("review_id", _S),
    ("pipeline_run_id", _S),
    ("store_id", _S),
    ("product_id", _S),
    ("content_hash", _S),
    ("shill_score", _L),
    ("template_detected", _B),
    ("template_id", _S),
    ("template_name", _S),
    ("linguistic_style", _S),
    ("detected_signals", SIGNALS),
    ("rationale_short", _S),
    ("model_id", _S),
    ("prompt_version", _S),
    ("score_source", _S),
    ("input_tokens", _L),
    ("output_tokens", _L),
    ("assessed_at", _T),
    ("signal_span_mismatch_count", _L),
)

ASSESSMENT_ERRORS = _table(
    ("review_id", _S),
    ("pipeline_run_id", _S),
    ("attempt_count", _L),
    ("http_status", _L),
    ("error_class", _S),
    ("error_message", _S),
    ("retryable", _B),
    ("failed_at", _T),
)

RUN_EVENTS = _table(
    ("pipeline_run_id", _S),
    ("phase", _S),
    ("status", _S),
    ("crawl_batch_id", _S),
    ("seed_version", _S),
    ("embedding_model", _S),
    ("scorer_model", _S),
    ("cosine_distance_threshold", _D),
    ("heartbeat_at", _T),
    ("started_at", _T),
    ("finished_at", _T),
    ("rows_in", _L),
    ("rows_out", _L),
    ("error_message", _S),
)

LABELS = _table(
    ("pipeline_run_id", _S),
    ("review_id", _S),
    ("label", _S),
    ("stratum", _S),
    ("notes", _S),
    ("labeled_at", _T),
)
