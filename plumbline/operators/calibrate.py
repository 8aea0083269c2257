"""Threshold sweep against human labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.constants import DISTANCE_GRID, HUMAN_LABELS, SCORE_THRESHOLD, SEED_DISTANCE_THRESHOLD
from plumbline.functions.scoring import safe_ratio

RUN = "pipeline_run_id"
_COUNTS = ["n_predicted_positive", "n_true_positive", "n_false_positive", "n_false_negative"]
_CLASSES = ["n_labeled", "n_shill", "n_not_shill", "n_unsure"]


def label_summary(labels: DataFrame) -> DataFrame:
    return labels.agg(*_class_counts())


def labelled(labels: DataFrame, audit: DataFrame, assessments: DataFrame, run_id: str) -> DataFrame:
    """Labels of a run with what the run measured for the same reviews."""
    mine = lambda df, *cols: df.where(F.col(RUN) == run_id).select("review_id", *cols)
    return (
        mine(labels, "label")
        .join(mine(audit, "min_cosine_distance"), "review_id", "left")
        .join(mine(assessments, "shill_score"), "review_id", "left")
    )


def _class_counts() -> list[Column]:
    return [F.count("*").alias("n_labeled")] + [
        F.count_if(F.col("label") == label).alias(f"n_{label}") for label in HUMAN_LABELS
    ]


def _confusion(predicted: Column) -> list[Column]:
    """Positives and errors of a prediction that may be NULL (= negative). Labels
    of ``unsure`` take no part."""
    yes = F.coalesce(predicted, F.lit(False))
    is_shill, is_not = F.col("label") == "shill", F.col("label") == "not_shill"
    return [
        F.count_if(yes & (is_shill | is_not)),
        F.count_if(yes & is_shill),
        F.count_if(yes & is_not),
        F.count_if(~yes & is_shill),
    ]


def _with_rates(df: DataFrame, usd_per_row: float | None) -> DataFrame:
    hits, wrong, missed = F.col("n_true_positive"), F.col("n_false_positive"), F.col("n_false_negative")
    price = F.lit(usd_per_row).cast("double")
    return df.select(
        "metric_kind",
        "cosine_distance_threshold",
        "shill_score_threshold",
        *_CLASSES,
        *_COUNTS,
        safe_ratio(hits, hits + wrong).alias("precision"),
        safe_ratio(hits, hits + missed).alias("recall"),
        "n_predicted_stage2",
        (F.col("n_predicted_stage2") * price).alias("estimated_usd"),
    )


def predicted_volume(audit: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Rows of the whole audit at or below each threshold, in one pass."""
    counts = audit.agg(
        F.array(
            *[
                F.struct(
                    F.lit(float(t)).alias("cosine_distance_threshold"),
                    F.count_if(F.col("min_cosine_distance") <= t).alias("n_predicted_stage2"),
                )
                for t in grid
            ]
        ).alias("rows")
    )
    return counts.select(F.inline("rows"))


def sweep_distance(
    labels: DataFrame, audit: DataFrame, grid: Sequence[float] = tuple(DISTANCE_GRID), usd_per_row: float | None = None
) -> DataFrame:
    """One row per distance threshold. All thresholds are counted in the same pass
    over the labels; nothing is multiplied out. No label, no row."""
    per_threshold = [
        F.struct(
            F.lit(float(t)).alias("cosine_distance_threshold"),
            *[c.alias(n) for c, n in zip(_confusion(F.col("min_cosine_distance") <= t), _COUNTS)],
        )
        for t in grid
    ]
    counts = labels.agg(*_class_counts(), F.array(*per_threshold).alias("rows")).where("n_labeled > 0")
    rows = counts.select(*_CLASSES, F.inline("rows")).join(
        predicted_volume(audit, grid), "cosine_distance_threshold"
    )
    return _with_rates(
        rows.withColumn("metric_kind", F.lit("layer2_distance")).withColumn(
            "shill_score_threshold", F.lit(None).cast("long")
        ),
        usd_per_row,
    )


def sweep_score(
    labels: DataFrame,
    stage2: DataFrame,
    min_score: int = SCORE_THRESHOLD,
    current_threshold: float = SEED_DISTANCE_THRESHOLD,
    usd_per_row: float | None = None,
) -> DataFrame:
    """One row for the score cut, at the distance threshold the run used."""
    confusion = [c.alias(n) for c, n in zip(_confusion(F.col("shill_score") >= min_score), _COUNTS)]
    row = (
        labels.agg(*_class_counts(), *confusion)
        .withColumn("metric_kind", F.lit("layer3_score"))
        .withColumn("cosine_distance_threshold", F.lit(float(current_threshold)))
        .withColumn("shill_score_threshold", F.lit(min_score).cast("long"))
        .withColumn("n_predicted_stage2", stage2.agg(F.count("*")).scalar())
    )
    return _with_rates(row, usd_per_row)


def calibrate(
    labels: DataFrame,
    audit: DataFrame,
    assessments: DataFrame,
    stage2: DataFrame,
    run_id: str,
    grid: Sequence[float] = tuple(DISTANCE_GRID),
    min_score: int = SCORE_THRESHOLD,
    current_threshold: float = SEED_DISTANCE_THRESHOLD,
    usd_per_row: float | None = None,
) -> DataFrame:
    joined = labelled(labels, audit, assessments, run_id)
    mine = lambda df: df.where(F.col(RUN) == run_id)
    by_distance = sweep_distance(joined, mine(audit), grid, usd_per_row)
    by_score = sweep_score(joined, mine(stage2), min_score, current_threshold, usd_per_row)
    return by_distance.unionByName(by_score)


def sweep_table(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy("metric_kind", "cosine_distance_threshold")
