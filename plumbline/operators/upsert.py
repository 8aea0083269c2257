"""Keyed maintenance as DataFrame rewrites.

A change set is small next to its table, so every rewrite keeps the changes on the
side that can be broadcast, checks their size, and falls back to a shuffled join:
a small load streams the table instead of shuffling it. Results go to a new
snapshot or partition, or to the buckets that changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.sizing import matching, small_side, without
from plumbline.schemas import RAW_REVIEWS, REWRITTEN_COLUMNS
from plumbline.session import durable
from plumbline.sources.buckets import BUCKET, BucketTable, buckets_of

RUN = "pipeline_run_id"


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``. Ties are broken by the whole row, so the
    result does not depend on partitioning. Rows combine before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(F.max(rank).alias("r")).select(
        *[F.col(c) if c in keys else F.col(f"r.{c}") for c in df.columns]
    )


def last_write_wins(df: DataFrame, key: str, file_order: Sequence[str]) -> DataFrame:
    """Last row per key in arrival order. A NULL or empty key never collapses: such
    rows are keyed by themselves."""
    keyed = F.coalesce(F.length(key) > 0, F.lit(False))
    alone = F.when(~keyed, F.monotonically_increasing_id())
    return latest_per_key(df.withColumn("alone", alone), [key, "alone"], file_order).drop("alone")


def merge_harvests(df: DataFrame, file_order: Sequence[str]) -> DataFrame:
    """Crawl files of one product: the last row of each native id, and every row without one."""
    return last_write_wins(df, "native_review_id", file_order)


def merge_preview(batch: DataFrame, target: DataFrame) -> DataFrame:
    """What a load would do to each row of ``batch``: insert, update or unchanged."""
    hit = matching(target.select("review_id", "content_hash"), batch, ["review_id"])
    stored = hit.select("review_id", F.col("content_hash").alias("stored_hash"), F.lit(True).alias("known"))
    op = (
        F.when(F.col("known").isNull(), "insert")
        .when(F.col("stored_hash") != F.col("content_hash"), "update")
        .otherwise("unchanged")
    )
    return batch.select("review_id", "content_hash").join(stored, "review_id", "left").select("review_id", op.alias("op"))


def merge_stats(preview: DataFrame) -> DataFrame:
    n = lambda op: F.count_if(F.col("op") == op)
    return preview.agg(
        n("insert").alias("n_inserted"),
        n("update").alias("n_updated"),
        n("unchanged").alias("n_unchanged"),
        n("unchanged").alias("n_already_present"),
    )


def updated_ids(preview: DataFrame) -> DataFrame:
    return preview.where(F.col("op") == "update").select("review_id")


def changed_ids(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids whose stored text differs from the batch's; written down, as the merge overwrites what they are read from."""
    return durable(updated_ids(merge_preview(batch, stored)))


def drop_vectors(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """Vectors without those of the given reviews."""
    return without(vectors, ids, ["review_id"])


def _rewritten(target: DataFrame, changes: DataFrame) -> DataFrame:
    """``target`` with the rewritable columns of the reviews whose text differs in ``changes`` (review_id, new)."""
    changed = F.coalesce(F.col("new.content_hash") != F.col("content_hash"), F.lit(False))
    return target.join(changes, "review_id", "left").select(
        *[
            F.when(changed, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in REWRITTEN_COLUMNS else F.col(c)
            for c in RAW_REVIEWS.names
        ]
    )


def upsert_reviews(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored reviews after a load: new ids are added, known ids change only when
    their text did, and then only in the rewritable columns. Unchanged reviews
    keep everything, their run included."""
    changes = small_side(batch.select("review_id", F.struct(*REWRITTEN_COLUMNS).alias("new")))
    known = matching(target.select("review_id"), batch, ["review_id"])
    added = batch.join(known, "review_id", "left_anti").select(*RAW_REVIEWS.names)
    return _rewritten(target, changes).unionByName(added)


def merge_reviews(table: BucketTable, batch: DataFrame) -> DataFrame:
    """Load ``batch`` (stored rows, one per id) into a bucketed table; returns what happened to each id.

    Only two columns of the batch's buckets are read to find out. New reviews are appended, and a bucket is written
    again only if it holds a review whose text changed. Loading the same batch again changes nothing, so a load that
    was cut off is repeated as a whole.
    """
    placed = batch.withColumn(BUCKET, table.bucket())
    preview = durable(merge_preview(batch, table.stored(buckets_of(placed))).withColumn(BUCKET, table.bucket()))
    ops = preview.select("review_id", "op")
    new = matching(placed, ops.where(F.col("op") == "insert"), ["review_id"])
    rewritten = buckets_of(preview.where(F.col("op") == "update"))
    apart = ~F.col(BUCKET).isin(rewritten) if rewritten else F.lit(True)
    if not new.where(apart).isEmpty():
        table.append(new.where(apart))
    if rewritten:
        edited = matching(placed, ops.where(F.col("op") == "update"), ["review_id"])
        changes = small_side(edited.select("review_id", F.struct(*REWRITTEN_COLUMNS).alias("new")))
        whole = _rewritten(table.stored(rewritten), changes).unionByName(new.where(~apart).select(*RAW_REVIEWS.names))
        table.replace_buckets(whole)
    return ops


def replace_keys(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` replace the target rows that have the same keys."""
    kept = without(target, rows, list(keys))
    return kept.select(*target.columns).unionByName(rows.select(*target.columns))


def upsert_assessments(
    target: DataFrame, rows: DataFrame, errors: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Assessments with ``rows`` inserted or replaced, and the errors left once the
    newly scored reviews are cleared."""
    keys = [RUN, "review_id"]
    return replace_keys(target, rows, keys), errors.join(rows.select(*keys), keys, "left_anti")


def append_errors(errors: DataFrame, rows: DataFrame) -> DataFrame:
    return errors.unionByName(rows.select(*errors.columns))


def append_copied(assessments: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates that are really new; existing assessments of a run stay."""
    keys = [RUN, "review_id"]
    return candidates.join(assessments.select(*keys), keys, "left_anti").select(*candidates.columns)


def copied_count(appended: DataFrame) -> DataFrame:
    return appended.agg(F.count("*").alias("n_copied"))


def upsert_labels(labels: DataFrame, rows: DataFrame, run_id: str) -> DataFrame:
    """Labels of a run with the given reviews relabelled."""
    stamped = rows.withColumn(RUN, F.lit(run_id)).withColumn("labeled_at", F.current_timestamp())
    return replace_keys(labels, stamped, [RUN, "review_id"])


def upsert_seeds(
    seeds: DataFrame,
    rows: DataFrame,
    version: str,
    activate: bool = True,
    protected: Sequence[str] = ("v0_hypothesis",),
) -> DataFrame:
    """Seed dimension with one version replaced by ``rows``; with ``activate`` all
    other versions are switched off. Built-in versions cannot be replaced."""
    if version in protected:
        raise ValueError(f"seed version {version} is built in; choose a new one")
    others = seeds.where(F.col("seed_version") != version)
    if activate:
        others = others.withColumn("is_active", F.lit(False))
    fresh = (
        rows.withColumn("seed_version", F.lit(version))
        .withColumn("is_active", F.lit(True))
        .withColumn("created_at", F.current_timestamp())
    )
    return reduce(DataFrame.unionByName, [others, fresh.select(*seeds.columns)])
