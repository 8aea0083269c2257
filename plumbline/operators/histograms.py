"""Fixed-bucket histograms. Each is one pass of conditional counts, so only one
row per task is exchanged; empty buckets appear with zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.constants import EXCLUSION_REASONS, SCORE_BINS, SCORE_THRESHOLD, SEED_DISTANCE_THRESHOLD
from plumbline.operators.stores import in_scope, of_run


def _unpivot(counts: DataFrame, names: list[str], keep_empty: Column) -> DataFrame:
    """One row per counted column, ``(position, bucket, n)``."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("bucket"), F.col(f"b{i}").alias("n"))
            for i, name in enumerate(names)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*").where(keep_empty | (F.col("n") > 0))


def _histogram(df: DataFrame, buckets: list[tuple[str, Column]], only_if_used: tuple[str, ...] = ()) -> DataFrame:
    """Count rows by the first bucket whose condition holds."""
    which = F.lit(None).cast("int")
    for i, (_, condition) in reversed(list(enumerate(buckets))):
        which = F.when(condition, F.lit(i)).otherwise(which)
    counts = df.select(which.alias("w")).agg(
        *[F.count_if(F.col("w") == i).alias(f"b{i}") for i in range(len(buckets))]
    )
    return _unpivot(counts, [name for name, _ in buckets], ~F.col("bucket").isin(list(only_if_used)))


def hist_l1(audit: DataFrame, raw: DataFrame, run_id: str) -> DataFrame:
    """Rule outcomes of the reviews a run owns; foreign reasons are ``unknown``."""
    reason = F.col("exclusion_reason")
    buckets = [(name, reason == name) for name in EXCLUSION_REASONS] + [("unknown", F.lit(True))]
    return _histogram(in_scope(audit, raw, run_id), buckets, only_if_used=("unknown",))


def l1_coverage(audit: DataFrame, raw: DataFrame, run_id: str) -> DataFrame:
    """Does the audit explain every review of the run?"""
    seen = in_scope(audit, raw, run_id).agg(F.count("*").alias("n_rows"))
    both = seen.withColumn("n_in_scope", of_run(raw, run_id).agg(F.count("*")).scalar())
    return both.withColumn("coverage_ok", F.col("n_rows") == F.col("n_in_scope"))


def distance_buckets(distance: Column, threshold: float) -> list[tuple[str, Column]]:
    """Quarters of the threshold (the last one includes it), then up to 1 and 2."""
    edges = [threshold / 4, threshold / 2, 3 * threshold / 4, threshold, 1.0, 2.0]
    lows = [0.0, *edges[:-1]]
    names = [f"{low:.2f}-{high:.2f}" for low, high in zip(lows, edges)]
    below = [distance < e for e in edges[:3]] + [distance <= e for e in edges[3:]]
    usable = distance.isNotNull() & ~F.isnan(distance) & distance.between(0, 2)
    return [("out_of_range", ~usable), *zip(names, below)]


def hist_l2(
    audit: DataFrame, stage1: DataFrame, raw: DataFrame, run_id: str, threshold: float = SEED_DISTANCE_THRESHOLD
) -> DataFrame:
    """Distances by bucket, plus stage-1 reviews that have none."""
    d = F.col("min_cosine_distance")
    owned = in_scope(stage1, raw, run_id).select("review_id")
    missing = owned.join(of_run(audit, run_id).select("review_id"), "review_id", "left_anti")
    rows = (
        in_scope(audit, raw, run_id)
        .select(d.cast("double").alias("min_cosine_distance"), F.lit(True).alias("measured"))
        .unionByName(
            missing.select(F.lit(None).cast("double").alias("min_cosine_distance"), F.lit(False).alias("measured"))
        )
    )
    out_of_range, *inside = distance_buckets(d, threshold)
    buckets = [("no_distance", ~F.col("measured")), out_of_range, *inside]
    counted = _histogram(rows, buckets, only_if_used=("out_of_range",))
    last = len(buckets)
    return counted.withColumn(
        "position",
        F.when(F.col("bucket") == "no_distance", last - 1)
        .when(F.col("bucket") == "out_of_range", last - 2)
        .otherwise(F.col("position") - 2),
    )


def l2_totals(
    audit: DataFrame, raw: DataFrame, run_id: str, threshold: float = SEED_DISTANCE_THRESHOLD
) -> DataFrame:
    d = F.col("min_cosine_distance")
    return in_scope(audit, raw, run_id).agg(
        F.count("*").alias("n_with_distance"),
        F.count_if(d.between(0, threshold)).alias("n_le_threshold"),
        F.count_if((d > threshold) & (d <= 2)).alias("n_gt_threshold"),
    )


def hist_l3(assessments: DataFrame, raw: DataFrame, run_id: str) -> DataFrame:
    score = F.col("shill_score")
    tops = [24, 49, 74, 100]
    buckets = [("out_of_range", score.isNull() | ~score.between(0, 100))]
    buckets += [(name, score <= top) for name, top in zip(SCORE_BINS, tops)]
    counted = _histogram(in_scope(assessments, raw, run_id), buckets, only_if_used=("out_of_range",))
    return counted.withColumn(
        "position", F.when(F.col("bucket") == "out_of_range", len(SCORE_BINS)).otherwise(F.col("position") - 1)
    )


def l3_totals(
    assessments: DataFrame,
    raw: DataFrame,
    run_id: str,
    min_score: int = SCORE_THRESHOLD,
    scorer_source: str = "scored",
) -> DataFrame:
    return in_scope(assessments, raw, run_id).agg(
        F.count("*").alias("n_assessed"),
        F.count_if(F.col("score_source") == scorer_source).alias("n_scored"),
        F.count_if(F.col("score_source") == "copied").alias("n_copied"),
        F.count_if(F.col("shill_score").between(min_score, 100)).alias("n_shill_75"),
    )
