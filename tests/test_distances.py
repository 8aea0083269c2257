from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import vectors as V
from plumbline.operators import embed, layer2


def frame(spark, matrix, prefix="r"):
    return spark.createDataFrame([(f"{prefix}{i}", [float(x) for x in row]) for i, row in enumerate(matrix)], "review_id string, embedding array<double>")


def seeds_of(spark, matrix):
    return spark.createDataFrame(
        [(f"s{i:02d}", f"c{i}", [float(x) for x in row]) for i, row in enumerate(matrix)], "seed_id string, category string, embedding array<double>"
    )


def nearest(matrix, seeds):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - unit(matrix) @ unit(seeds).T
    return {f"r{i}": (f"s{row.argmin():02d}", round(row.min(), 9)) for i, row in enumerate(d)}


def test_nearest_seed_local_and_by_blocks(spark):
    rng = np.random.default_rng(7)
    matrix, seeds = rng.normal(size=(200, 16)), rng.normal(size=(23, 16))
    for local in (1024, 5):
        got = layer2.nearest_seed(frame(spark, matrix), seeds_of(spark, seeds), max_local=local)
        assert {r.review_id: (r.matched_seed_id, round(r.min_cosine_distance, 9)) for r in got.collect()} == nearest(matrix, seeds)


def test_ties_go_to_the_smaller_seed_and_rows_are_unique(spark):
    one = np.array([[1.0, 0.0]])
    twice = frame(spark, one).unionByName(frame(spark, one))
    for local in (10, 1):
        rows = layer2.nearest_seed(twice, seeds_of(spark, np.array([[2.0, 0.0], [1.0, 0.0]])), max_local=local).collect()
        assert [(r.review_id, r.matched_seed_id) for r in rows] == [("r0", "s00")]


def test_uneven_vectors_and_missing_seeds_are_errors(spark):
    mixed = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], "review_id string, embedding array<double>").coalesce(1)
    with pytest.raises(Exception, match="different width"):
        layer2.nearest_seed(mixed, seeds_of(spark, np.eye(2))).collect()
    with pytest.raises(ValueError, match="no active seed"):
        layer2.nearest_seed(mixed, seeds_of(spark, np.eye(2)).limit(0))


def test_vectors_of_other_reviews_are_left_out_at_the_scan(spark, folder):
    rng = np.random.default_rng(3)
    frame(spark, rng.normal(size=(3000, 8))).write.parquet(f"{folder}/v")
    vectors, seeds = spark.read.parquet(f"{folder}/v"), seeds_of(spark, rng.normal(size=(4, 8)))
    ids = vectors.where("hash(review_id) % 20 = 0").select("review_id")
    kept = {r[0] for r in layer2.among(vectors, ids).select("review_id").collect()}
    want = {r[0] for r in ids.collect()}
    assert want <= kept and len(kept) < len(want) + 3000 * 0.05
    assert layer2.among(vectors, ids.limit(0)).count() == 0
    # The filter stands between the scan and the distances, and nothing but winners is shuffled.
    plan = layer2.nearest_seed(layer2.among(vectors, ids), seeds)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("nearest(") < plan.index("Filter pythonUDF") < plan.index("may_be_in(") < plan.index("FileScan")
    assert "embedding" not in plan[: plan.index("nearest(")] and "Join" not in plan


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(layer2, "FILTER_BITS", 64)
    vectors = frame(spark, np.eye(8).repeat(40, axis=0))
    ids = vectors.select("review_id").limit(200)
    assert {r[0] for r in ids.collect()} <= {r[0] for r in layer2.among(vectors, ids).select("review_id").collect()}


def test_expression_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(V.cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 - 2**-0.5) and got[1] is None


STAGE1 = "pipeline_run_id string, review_id string, store_id string, product_id string, comment_text string, content_hash string"
VECTORS = "pipeline_run_id string, review_id string, content_hash string, embedding array<double>, embedding_model string, status string"


def test_vectors_of_other_runs_are_reused_and_errors_ignored(spark):
    stage1 = spark.createDataFrame([("r", i, "s", "p", "t", "h") for i in "abcd"], STAGE1).withColumn("review_ts", F.current_timestamp())
    vectors = spark.createDataFrame(
        [("old", "a", "h", [1.0, 0.0], "m", "ok"), ("r", "b", "h", [], "m", "error"), ("r", "b", "h", [], "m", "error"),
         ("r", "c", "h", [0.0, 1.0], "m", "ok"), ("r", "d", "h", [0.0, 1.0], "other", "ok"), ("r", "zz", "h", [1.0, 0.0], "m", "ok")], VECTORS,
    )
    seeds = seeds_of(spark, np.array([[1.0, 0.0]]))
    audit = layer2.distance_audit(stage1, vectors, seeds, "r", "m", 0.28)
    assert {r.review_id: r.min_cosine_distance for r in audit.collect()} == {"a": 0.0, "c": 1.0}
    stage2 = layer2.l2_filter(audit, 1.0)
    assert stage2.count() == 2 and layer2.l2_filter(audit, 0.28).count() == 1
    summary = layer2.l2_funnel(stage1, vectors, stage2, "m").first().asDict()
    assert summary == {"n_embedded_ok": 2, "n_embedded_err": 2, "n_stage1": 4, "n_suspicious": 2}
    assert {r.review_id for r in embed.embed_pending(stage1, vectors, "m").collect()} == {"b", "d"}
    assert [tuple(r) for r in embed.vector_dims(stage1, vectors, "m").collect()] == [(2, 2)]
    embed.check_vector_dims(embed.vector_dims(stage1, vectors, "m"), 2)
    with pytest.raises(ValueError):
        embed.check_vector_dims(embed.vector_dims(stage1, vectors, "m"), 768)


def test_stale_vectors(spark):
    stage1 = spark.createDataFrame([("r", "a", "s", "p", "t", "new"), ("r", "b", "s", "p", "t", "h")], STAGE1)
    vectors = spark.createDataFrame([("r", i, "h", [1.0], m, "ok") for i in "abx" for m in ("m", "other")], VECTORS)
    left = {(r.review_id, r.embedding_model) for r in embed.drop_stale_vectors(vectors, stage1, "m").collect()}
    assert left == {("a", "other"), ("b", "m"), ("b", "other"), ("x", "m"), ("x", "other")}


def test_embedder_failures_are_kept_as_empty(spark):
    stage1 = spark.createDataFrame([("r", "a", "s", "p", "some text", "h"), ("r", "b", "s", "p", "x", "h")], STAGE1)
    vectors = spark.createDataFrame([], VECTORS)
    made = {r.review_id: r for r in embed.embed_missing(stage1, vectors, embed.HashedTrigrams(8), "m", "r").collect()}
    assert made["a"].status == "ok" and len(made["a"].embedding) == 8 and np.linalg.norm(made["a"].embedding) == pytest.approx(1)
    assert made["b"].status == "error" and made["b"].embedding == [] and made["b"].status_detail == "text too short"
    capped = embed.embed_missing(stage1, vectors, embed.HashedTrigrams(8), "m", "r", char_cap=2)
    assert {r.status for r in capped.collect()} == {"error"}
    seeds = spark.createDataFrame(
        [("s1", "c", "seed text", "v1", True), ("s2", "c", "x", "v1", True), ("s3", "c", "seed text", "v1", False), ("s4", "c", "seed text", "v0", True)],
        "seed_id string, category string, seed_text string, seed_version string, is_active boolean",
    )
    found = embed.embed_seeds(seeds, embed.HashedTrigrams(8), "m", "v1")
    assert [r.seed_id for r in found.collect()] == ["s1"]
    assert embed.replace_seed_vectors(found, found, "v1", "m").count() == 1


def test_gates(spark):
    stage1 = spark.createDataFrame([("r", "a", "s", "p", "t", "h")], STAGE1)
    none = spark.createDataFrame([], VECTORS)
    seeds = seeds_of(spark, np.eye(2))
    with pytest.raises(ValueError, match="no active seeds"):
        layer2.layer2_gates(seeds.limit(0), stage1, none, "m")
    with pytest.raises(ValueError, match="usable vector"):
        layer2.layer2_gates(seeds, stage1, none, "m")
    layer2.layer2_gates(seeds, stage1.limit(0), none, "m")
