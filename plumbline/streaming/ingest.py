"""Continuous form of ingest and load for a folder that keeps receiving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions import text
from plumbline.operators import upsert
from plumbline.plans.steps import merge_batch
from plumbline.plans.store import ReviewStore
from plumbline.sources import reviews
from plumbline.sources.tables import stage_batch, write_slice


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New review JSONL files as they arrive, with the place of each line's block."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        "value",
    )


def load_micro_batch(store: ReviewStore, lines: DataFrame, salt: str, batch_id: str, run_id: str) -> None:
    """One micro-batch through the ordinary steps: only the buckets of its reviews are touched, vectors of changed
    reviews are dropped, and rejects are kept as one slice per batch. Loading the same lines again changes nothing and
    replaces that slice, so a batch replayed after a failure is harmless."""
    numbered = lines.select(
        "source_file",
        "source_block",
        F.monotonically_increasing_id().alias("source_line"),
        text.trim_spaces(F.col("value")).alias("line"),
    ).where("line <> ''")
    good, bad = reviews.split_rejects(reviews.parse_reviews(numbered))
    now = store.spark.sql("SELECT current_timestamp()").first()[0]
    rows = reviews.normalize_reviews(good, salt, batch_id, run_id, now)
    unique = upsert.last_write_wins(rows, "review_id", reviews.FILE_ORDER).drop(*reviews.FILE_ORDER)
    latest = upsert.latest_per_key(unique, "review_id", ["updated_at"])
    staged = stage_batch(latest, f"{store.path('stream_batches')}/{batch_id}")
    write_slice(bad, store.path("stream_rejects"), crawl_batch_id=batch_id)
    if not staged.isEmpty():
        merge_batch(store, staged)


def stream_ingest(
    store: ReviewStore, path: str, salt: str, run_id: str, checkpoint: str, files_per_batch: int | None = None, **trigger
) -> StreamingQuery:
    """Start the stream; ``trigger`` is passed on, such as ``availableNow=True``."""

    def load(lines: DataFrame, number: int) -> None:
        load_micro_batch(store, lines, salt, f"{run_id}-{number}", run_id)

    writer = stream_lines(store.spark, path, files_per_batch).writeStream.foreachBatch(load)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
