"""Per-store rates and the run funnel. Stage rows only count for reviews that the
raw table still assigns to the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.constants import SCORE_THRESHOLD
from plumbline.functions.scoring import funnel_tightness, safe_ratio

RUN = "pipeline_run_id"


def of_run(df: DataFrame, run_id: str) -> DataFrame:
    return df.where(F.col(RUN) == run_id)


def in_scope(df: DataFrame, raw: DataFrame, run_id: str) -> DataFrame:
    """Rows of a run whose review the run still owns. Every call shuffles the same
    id column of ``raw`` the same way, so one plan computes that exchange once."""
    return of_run(df, run_id).join(of_run(raw, run_id).select("review_id"), "review_id", "left_semi")


def store_raw_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("store_id").agg(
        F.min("marketplace").alias("marketplace"), F.count("*").alias("n_raw")
    )


def store_stage1_counts(stage1: DataFrame) -> DataFrame:
    return stage1.groupBy("store_id").agg(F.count("*").alias("n_stage1"))


def store_stage2_counts(stage2: DataFrame) -> DataFrame:
    return stage2.groupBy("store_id").agg(
        F.count("*").alias("n_stage2"), F.avg("min_cosine_distance").alias("avg_min_seed_distance")
    )


def store_scores(assessments: DataFrame, min_score: int = SCORE_THRESHOLD) -> DataFrame:
    """Scores are whole numbers 0-100, so the exact median needs at most 101 counters."""
    return assessments.groupBy("store_id").agg(
        F.count("*").alias("n_assessed"),
        F.count_if(F.col("shill_score") >= min_score).alias("n_shill_75"),
        F.count_if("template_detected").alias("n_template_hit"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY shill_score)").cast("double").alias("p50_shill_score"),
    )


def store_stats(
    raw: DataFrame,
    stage1: DataFrame,
    stage2: DataFrame,
    assessments: DataFrame,
    run_id: str,
    min_score: int = SCORE_THRESHOLD,
) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        store_raw_counts(of_run(raw, run_id))
        .join(store_stage1_counts(in_scope(stage1, raw, run_id)), "store_id", "left")
        .join(store_stage2_counts(in_scope(stage2, raw, run_id)), "store_id", "left")
        .join(store_scores(in_scope(assessments, raw, run_id), min_score), "store_id", "left")
        .select(
            "store_id",
            "marketplace",
            "n_raw",
            zero("n_stage1"),
            zero("n_stage2"),
            zero("n_assessed"),
            zero("n_shill_75"),
            safe_ratio(F.col("n_shill_75"), F.col("n_assessed")).alias("pct_shill_75"),
            "n_template_hit",
            safe_ratio(F.col("n_template_hit"), F.col("n_assessed")).alias("template_hit_rate"),
            "avg_min_seed_distance",
            "p50_shill_score",
        )
    )


def top_stores(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc_nulls_last("pct_shill_75"), F.desc("n_shill_75"), "store_id")


def funnel(
    raw: DataFrame,
    stage1: DataFrame,
    stage2: DataFrame,
    assessments: DataFrame,
    errors: DataFrame,
    run_id: str,
) -> DataFrame:
    """Stage counts of a run and their ratios, as one row.

    All tables meet in one shuffle on the review id: each contributes a marker
    column, and an id counts only where the raw marker is present.
    """
    sources = {"n_raw": raw, "n_stage1": stage1, "n_stage2": stage2, "n_assessed": assessments, "n_assess_errors": errors}
    marked = None
    for name, df in sources.items():
        rows = of_run(df, run_id).select(
            "review_id", *[F.lit(1 if name == other else 0).cast("long").alias(other) for other in sources]
        )
        marked = rows if marked is None else marked.unionByName(rows)
    per_review = marked.groupBy("review_id").agg(*[F.sum(n).alias(n) for n in sources]).where("n_raw > 0")
    totals = per_review.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sources])
    ratio = lambda a, b: safe_ratio(F.col(a), F.col(b))
    return totals.select(
        *sources,
        ratio("n_stage1", "n_raw").alias("pct_stage1"),
        ratio("n_stage2", "n_raw").alias("pct_stage2_of_raw"),
        ratio("n_stage2", "n_stage1").alias("pct_stage2_of_stage1"),
        funnel_tightness(ratio("n_stage2", "n_raw")).alias("tightness"),
    )


def latest_funnel(funnel_rows: DataFrame, run_id: str) -> DataFrame:
    """Newest funnel row of a run."""
    rest = [c for c in funnel_rows.columns if c not in (RUN, "computed_at")]
    return (
        of_run(funnel_rows, run_id)
        .groupBy(RUN)
        .agg(F.max_by(F.struct(*rest), F.struct("computed_at", *rest)).alias("f"), F.max("computed_at").alias("computed_at"))
        .select(RUN, "f.*", "computed_at")
    )


def run_summary(
    stats: DataFrame, bursts: DataFrame, pair_counts: DataFrame, edges: DataFrame, funnel_rows: DataFrame, assessments: DataFrame
) -> DataFrame:
    """One row of totals over a run's result tables."""
    first = funnel_rows.agg(
        F.count("*").alias("n_funnel"),
        *[F.min(c).alias(c) for c in ("n_raw", "n_stage1", "n_stage2", "pct_stage2_of_raw")],
    )
    n = lambda df: df.agg(F.count("*")).scalar()
    return (
        first.withColumn("n_store_stats", n(stats))
        .withColumn("n_burst_events", n(bursts))
        .withColumn("n_burst_flagged", bursts.agg(F.count_if("is_burst")).scalar())
        .withColumn("n_collisions", pair_counts.agg(F.coalesce(F.sum("n_pairs"), F.lit(0))).scalar())
        .withColumn("n_edges", n(edges))
        .withColumn("n_assessed", n(assessments))
    )
