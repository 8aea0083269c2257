from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.functions import scoring
from plumbline.operators import calibrate, histograms, stores


@pytest.fixture
def run(spark):
    make = spark.createDataFrame
    raw = make(
        [("r", i, "m", s) for i, s in [("a", "s1"), ("b", "s1"), ("c", "s2")]] + [("new", "moved", "m", "s1")],
        "pipeline_run_id string, review_id string, marketplace string, store_id string",
    )
    audit1 = make(
        [("r", "a", "s1", "pass"), ("r", "b", "s1", "too_short"), ("r", "c", "s2", "strange"), ("r", "moved", "s1", "pass")],
        "pipeline_run_id string, review_id string, store_id string, exclusion_reason string",
    )
    stage1 = make([("r", "a", "s1"), ("r", "c", "s2"), ("r", "moved", "s1")], "pipeline_run_id string, review_id string, store_id string")
    audit2 = make(
        [("r", "a", "s1", 0.28), ("r", "moved", "s1", 0.1)], "pipeline_run_id string, review_id string, store_id string, min_cosine_distance double"
    )
    scores = make(
        [("r", "a", "s1", 80, True, "scored"), ("r", "b", "s1", 75, False, "copied"), ("r", "moved", "s1", 99, True, "scored")],
        "pipeline_run_id string, review_id string, store_id string, shill_score long, template_detected boolean, score_source string",
    )
    errors = make([("r", "c"), ("r", "c"), ("r", "moved")], "pipeline_run_id string, review_id string")
    return raw, audit1, stage1, audit2, scores, errors


def test_store_stats_count_only_owned_reviews(run):
    raw, _, stage1, stage2, scores, _ = run
    got = {r.store_id: r for r in stores.store_stats(raw, stage1, stage2, scores, "r").collect()}
    one, two = got["s1"], got["s2"]
    assert (one.n_raw, one.n_stage1, one.n_stage2, one.n_assessed, one.n_shill_75) == (2, 1, 1, 2, 2)
    assert (one.pct_shill_75, one.n_template_hit, one.template_hit_rate, one.avg_min_seed_distance, one.p50_shill_score) == (1.0, 1, 0.5, 0.28, 75.0)
    assert (two.n_raw, two.n_stage1, two.n_assessed, two.pct_shill_75, two.n_template_hit) == (1, 1, 0, None, None)
    assert [r.store_id for r in stores.top_stores(stores.store_stats(raw, stage1, stage2, scores, "r")).collect()] == ["s1", "s2"]


def test_funnel(run, spark):
    raw, _, stage1, stage2, scores, errors = run
    row = stores.funnel(raw, stage1, stage2, scores, errors, "r").first()
    assert (row.n_raw, row.n_stage1, row.n_stage2, row.n_assessed, row.n_assess_errors) == (3, 2, 1, 2, 2)
    assert (row.pct_stage1, row.pct_stage2_of_stage1, row.tightness) == (pytest.approx(2 / 3), 0.5, "loose")
    empty = stores.funnel(raw, stage1, stage2, scores, errors, "none").first()
    assert (empty.n_raw, empty.pct_stage1, empty.tightness) == (0, None, "unknown")
    rows = stores.funnel(raw, stage1, stage2, scores, errors, "r").withColumn("pipeline_run_id", F.lit("r"))
    both = rows.withColumn("computed_at", F.lit("2024-01-02").cast("timestamp")).unionByName(
        rows.withColumn("n_raw", F.lit(99).cast("long")).withColumn("computed_at", F.lit("2024-01-01").cast("timestamp"))
    )
    assert stores.latest_funnel(both, "r").first().n_raw == 3


def test_histograms(run, spark):
    raw, audit1, stage1, audit2, scores, _ = run
    shown = lambda df: [(r.bucket, r.n) for r in df.orderBy("position").collect()]
    assert shown(histograms.hist_l1(audit1, raw, "r")) == [("non_five_star", 0), ("too_short", 1), ("pure_logistics", 0), ("pass", 1), ("unknown", 1)]
    assert histograms.l1_coverage(audit1, raw, "r").first().coverage_ok is True
    assert shown(histograms.hist_l2(audit2, stage1, raw, "r")) == [
        ("0.00-0.07", 0), ("0.07-0.14", 0), ("0.14-0.21", 0), ("0.21-0.28", 1), ("0.28-1.00", 0), ("1.00-2.00", 0), ("no_distance", 1),
    ]
    assert tuple(histograms.l2_totals(audit2, raw, "r").first()) == (1, 1, 0)
    assert shown(histograms.hist_l3(scores, raw, "r")) == [("0-24", 0), ("25-49", 0), ("50-74", 0), ("75-100", 2)]
    assert tuple(histograms.l3_totals(scores, raw, "r").first()) == (2, 1, 1, 2)


def test_distance_buckets_at_their_edges(spark):
    values = [0.0, 0.07, 0.1399, 0.14, 0.2101, 0.28, 0.2801, 1.0, 1.5, 2.0, 2.1, -0.1, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    name = F.lit(None).cast("string")
    for label, condition in reversed(histograms.distance_buckets(F.col("d"), 0.28)):
        name = F.when(condition, label).otherwise(name)
    got = [r[0] for r in df.select(name).collect()]
    assert got == ["0.00-0.07", "0.07-0.14", "0.07-0.14", "0.14-0.21", "0.21-0.28", "0.21-0.28", "0.28-1.00", "0.28-1.00", "1.00-2.00", "1.00-2.00"] + ["out_of_range"] * 3


def test_calibration(spark):
    labels = spark.createDataFrame(
        [("r", "a", "shill"), ("r", "b", "shill"), ("r", "c", "not_shill"), ("r", "d", "unsure"), ("r", "e", "shill"), ("x", "z", "shill")],
        "pipeline_run_id string, review_id string, label string",
    )
    audit = spark.createDataFrame(
        [("r", "a", 0.1), ("r", "b", 0.3), ("r", "c", 0.25), ("r", "d", 0.1), ("r", "q", 0.05)],
        "pipeline_run_id string, review_id string, min_cosine_distance double",
    )
    scores = spark.createDataFrame([("r", "a", 80), ("r", "c", 90), ("r", "b", 74)], "pipeline_run_id string, review_id string, shill_score long")
    stage2 = audit.where("min_cosine_distance <= 0.28")
    rows = calibrate.sweep_table(calibrate.calibrate(labels, audit, scores, stage2, "r", grid=[0.05, 0.25, 0.3], usd_per_row=0.5)).collect()
    shown = [(r.metric_kind, r.n_labeled, r.n_predicted_positive, r.n_true_positive, r.n_false_positive, r.n_false_negative, r.precision, r.recall, r.n_predicted_stage2, r.estimated_usd) for r in rows]
    third = pytest.approx(1 / 3)
    assert shown == [
        ("layer2_distance", 5, 0, 0, 0, 3, None, 0.0, 1, 0.5),
        ("layer2_distance", 5, 2, 1, 1, 2, 0.5, third, 4, 2.0),
        ("layer2_distance", 5, 3, 2, 1, 1, pytest.approx(2 / 3), pytest.approx(2 / 3), 5, 2.5),
        ("layer3_score", 5, 2, 1, 1, 2, 0.5, third, 4, 2.0),
    ]
    unpriced = calibrate.calibrate(labels, audit, scores, stage2, "r", grid=[0.25]).collect()
    assert {r.estimated_usd for r in unpriced} == {None}
    none = calibrate.calibrate(labels, audit, scores, stage2, "none", grid=[0.25]).collect()
    assert [r.metric_kind for r in none] == ["layer3_score"]
    assert tuple(calibrate.label_summary(labels).first()) == (6, 4, 1, 1)


def test_tightness_formats_and_prices(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    tight = lambda x: value(scoring.funnel_tightness(F.lit(x).cast("double")))
    assert [tight(x) for x in (None, 0.151, 0.15, 0.01, 0.0099, float("nan"))] == ["unknown", "loose", "ok", "ok", "tight", "unknown"]
    assert value(scoring.fmt_pct(F.lit(0.5294))) == "52.9%" and value(scoring.fmt_pct(F.lit(None))) == "n/a"
    assert value(scoring.fmt_num(F.lit(0.12345))) == "0.123"
    cost = lambda m: value(scoring.token_cost(F.lit(m), F.lit(900), F.lit(250)))
    assert cost("x-3.5-Flash") == pytest.approx(0.0036) and cost("x-3.1-flash-lite") == pytest.approx(0.0006)
    assert cost("x-3.5-flash-lite") is None and cost("other") is None


def test_error_classes(spark):
    rows = [(429, "x", None), (503, "x", None), (400, "timeout", None), (404, "x", None), (404, "ETIMEDOUT", None), (None, "x", "AbortError"), (None, "x", None), (505, "x", None), (None, None, None)]
    df = spark.createDataFrame(rows, "s int, m string, k string")
    got = [tuple(r[0]) for r in df.select(scoring.classify_error(F.col("s"), F.col("m"), F.col("k"))).collect()]
    assert got == [
        ("rate_limit", True, 429), ("server", True, 503), ("unknown", False, 400), ("unknown", False, 404), ("timeout", True, None),
        ("timeout", True, None), ("unknown", True, None), ("unknown", True, None), ("unknown", True, None),
    ]
