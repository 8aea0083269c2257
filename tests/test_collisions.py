from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import vectors as V
from plumbline.operators import collisions as X

ASSESSED = "pipeline_run_id string, review_id string, store_id string, template_detected boolean, template_id string, shill_score long"


def ordered(a, b):
    return (a, b) if a["store"] < b["store"] else (b, a)


def template_rows():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        template = ["hot", "hot", "hot", "cold", "unlisted_template", None][rng.integers(0, 6)]
        rows.append(("r" if i % 9 else "other", f"v{i:03d}", f"s{rng.integers(0, 7)}", bool(rng.integers(0, 5)), template, int(rng.integers(60, 101))))
    return rows


def wanted_template_pairs(rows):
    fit = [r for r in rows if r[0] == "r" and r[3] and r[4] not in (None, "unlisted_template") and r[5] >= 75]
    out = set()
    for a, b in combinations(fit, 2):
        if a[4] == b[4] and a[2] != b[2]:
            x, y = (a, b) if a[2] < b[2] else (b, a)
            out.add((x[2], y[2], x[1], y[1], a[4]))
    return out


@pytest.mark.parametrize("chunk_rows", [20_000, 4])
def test_template_pairs_and_edges(spark, chunk_rows):
    rows = template_rows()
    members = X.template_members(spark.createDataFrame(rows, ASSESSED), "r")
    matches = X.same_group(members)
    pairs = X.collision_pairs(members, matches, "template", chunk_rows)
    listed = [(r.store_id_a, r.store_id_b, r.review_id_a, r.review_id_b, r.template_id) for r in pairs.collect()]
    want = wanted_template_pairs(rows)
    assert len(listed) == len(want) and set(listed) == want

    weight, templates = Counter(), defaultdict(set)
    for a, b, _, _, t in want:
        weight[a, b] += 1
        templates[a, b].add(t)
    expected = {(*k, n, tuple(sorted(templates[k]))) for k, n in weight.items()}
    shown = lambda df: {(r.src_store_id, r.dst_store_id, r.weight, tuple(r.template_ids)) for r in df.collect()}
    assert shown(X.edges_from_pairs(pairs)) == expected
    counted = X.store_pair_counts(members, matches, "template", chunk_rows=2 if chunk_rows == 4 else chunk_rows)
    assert shown(X.edges_from_counts(counted)) == expected
    best = X.top_edges(X.edges_from_counts(counted)).first()
    assert best.weight == max(weight.values())


def clustered(rng, width=12):
    """Tight clusters far apart plus scattered vectors and exact copies."""
    centres = np.linalg.qr(rng.normal(size=(width, width)))[0][:6]
    near = [c + rng.normal(scale=0.02, size=width) for c in centres for _ in range(25)]
    loose = list(rng.normal(size=(40, width)))
    return np.array(near + loose + [near[0]] * 12)


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_similar_vectors_are_exact(spark, block_rows):
    rng = np.random.default_rng(11)
    matrix = clustered(rng)
    stores = [f"s{rng.integers(0, 5)}" for _ in matrix]
    df = spark.createDataFrame(
        [(f"v{i:03d}", s, None, [float(x) for x in row]) for i, (s, row) in enumerate(zip(stores, matrix))],
        "review_id string, store_id string, shill_score long, embedding array<double>",
    ).select("store_id", "review_id", "shill_score", V.keyed_unit("embedding").alias("v"))
    members = df.selectExpr("v.vector_key AS member_group", "store_id", "review_id", "shill_score", "v.unit AS unit")
    assert members.select("member_group").distinct().count() == len(matrix) - 12
    matches = X.similar_vectors(members, 0.2, block_rows)
    pairs = X.collision_pairs(members, matches, "embedding", chunk_rows=5).collect()

    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    distance = 1 - unit @ unit.T
    want = {}
    for i, j in combinations(range(len(matrix)), 2):
        if stores[i] != stores[j] and distance[i, j] <= 0.2:
            a, b = (i, j) if stores[i] < stores[j] else (j, i)
            want[f"v{a:03d}", f"v{b:03d}"] = round(float(distance[i, j]), 6) + 0.0
    got = {(r.review_id_a, r.review_id_b): round(r.cosine_distance, 6) for r in pairs}
    assert len(pairs) == len(got) and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    counted = X.store_pair_counts(members, matches, "embedding", chunk_rows=2)
    weight = Counter((r.store_id_a, r.store_id_b) for r in pairs)
    assert {(r.src_store_id, r.dst_store_id): r.weight for r in X.edges_from_counts(counted).collect()} == dict(weight)


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_pairs_where_matches_are_found_equal_listed_matches(spark, block_rows):
    """Many copies of one vector, vectors without direction, reviews without score or store."""
    rng = np.random.default_rng(3)
    matrix = np.concatenate([clustered(rng), np.repeat(rng.normal(size=(1, 12)), 40, axis=0), np.zeros((9, 12))])
    rows = [(f"v{i:03d}", f"s{i * 7 % 5}" if i % 31 else None, i if i % 3 else None, [float(x) for x in row]) for i, row in enumerate(matrix)]
    members = spark.createDataFrame(rows, "review_id string, store_id string, shill_score long, embedding array<double>").select(
        "store_id", "review_id", "shill_score", V.keyed_unit("embedding").alias("v")
    ).selectExpr("v.vector_key AS member_group", "store_id", "review_id", "shill_score", "v.unit AS unit").cache()
    matches = X.similar_vectors(members, 0.2)
    shown = lambda df: sorted(tuple("" if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    listed, found = X.collision_pairs(members, matches, "embedding"), X.similar_pairs(members, 0.2, block_rows, chunk_rows=4)
    assert found.columns == listed.columns and found.dtypes == listed.dtypes
    assert shown(found) == shown(listed) and any(r.cosine_distance == 0 for r in found.collect())
    counted, there = X.store_pair_counts(members, matches, "embedding"), X.similar_store_counts(members, 0.2, block_rows, chunk_rows=2)
    assert there.columns == counted.columns and shown(there) == shown(counted)


def test_found_pairs_are_not_shuffled(spark):
    rows = [("r", f"v{i}", f"s{i % 4}", [1.0, i / 50]) for i in range(50)]
    df = spark.createDataFrame(rows, "pipeline_run_id string, review_id string, store_id string, embedding array<double>")
    vectors = df.withColumns({"embedding_model": F.lit("m"), "status": F.lit("ok")}).drop("store_id")
    found = X.semantic_collisions(df.drop("embedding"), vectors, df.select("pipeline_run_id", "review_id", F.lit(80).alias("shill_score")), "r", "m")
    plan = found._jdf.queryExecution().executedPlan().toString().split("FlatMapGroupsInArrow")
    assert len(plan) > 1 and "Exchange" not in plan[0] and "Join" not in plan[0]
    assert found.count() > 500


def test_far_blocks_are_skipped(spark):
    """Clusters at right angles: only blocks of the same cluster are compared."""
    rng = np.random.default_rng(2)
    rows = [(f"k{c}{i:03d}", [float(x) for x in np.eye(6)[c] + rng.normal(scale=0.01, size=6)]) for c in range(6) for i in range(32)]
    members = spark.createDataFrame(rows, "member_group string, unit array<double>").select(
        "member_group", V.keyed_unit("unit").alias("v")
    ).selectExpr("v.vector_key AS member_group", "v.unit AS unit")
    assert X.similar_vectors(members, 0.05, block_rows=8).count() == 6 * 32 * 32


def test_vectors_move_only_where_they_may_match(spark):
    """Clusters too wide for the pivots alone to part: slim rows go to every block, whole vectors to a few."""
    rng = np.random.default_rng(7)
    width, rows = 96, []
    for centre in np.linalg.qr(rng.normal(size=(width, 24)))[0].T:
        rows += [centre + rng.normal(scale=0.055, size=width) for _ in range(40)]
    matrix = np.array(rows)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    df = spark.createDataFrame([(hashlib.sha256(row.tobytes()).hexdigest(), [float(x) for x in row]) for row in unit], "member_group string, unit array<double>")
    distinct = df.withColumn("id", F.monotonically_increasing_id())
    moved = X.block_pairs(distinct, 0.35, block_rows=16).cache()
    pairs = moved.select("low", "high").distinct().count()
    found = X.similar_vectors(df, 0.35, block_rows=16)
    assert found.count() == int((1 - unit @ unit.T <= 0.35 + 1e-12).sum())
    blocks = len(unit) // 16
    assert moved.count() / len(unit) < blocks / 4 and pairs < blocks * blocks / 8
    # Without the short basis the pivots rule out hardly any pair of blocks.
    short, X.SHORT_WIDTH = X.SHORT_WIDTH, 1
    try:
        wide = X.block_pairs(distinct, 0.35, block_rows=16)
        assert wide.count() > 3 * moved.count()
        assert X.similar_vectors(df, 0.35, block_rows=16).count() == found.count()
    finally:
        X.SHORT_WIDTH = short


def test_vectors_without_direction_match_themselves_alone(spark):
    df = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [1.0, 0.001])], "member_group string, embedding array<double>")
    members = df.select("member_group", V.keyed_unit("embedding").alias("v")).selectExpr("member_group", "v.unit AS unit")
    assert sorted((r.group_a, r.group_b) for r in X.similar_vectors(members, 0.2).collect()) == [("a", "a"), ("b", "b"), ("b", "c"), ("c", "b"), ("c", "c")]
    assert X.similar_vectors(members.where("member_group = 'a'")).count() == 1


def test_nothing_to_compare(spark):
    members = spark.createDataFrame([], "member_group string, store_id string, review_id string, shill_score long, unit array<double>")
    assert X.similar_vectors(members).count() == 0


def test_only_vectors_of_the_run_count_by_default(spark):
    stage2 = spark.createDataFrame([("r", "a", "s1"), ("r", "b", "s2")], "pipeline_run_id string, review_id string, store_id string")
    vectors = spark.createDataFrame(
        [("r", "a", [1.0, 0.0], "m", "ok"), ("old", "b", [1.0, 0.0], "m", "ok")],
        "pipeline_run_id string, review_id string, embedding array<double>, embedding_model string, status string",
    )
    scores = spark.createDataFrame([("r", "a", 80)], "pipeline_run_id string, review_id string, shill_score long")
    assert X.semantic_collisions(stage2, vectors, scores, "r", "m").count() == 0
    found = X.semantic_collisions(stage2, vectors, scores, "r", "m", require_same_run=False).collect()
    assert [(r.review_id_a, r.review_id_b, r.shill_score_a, r.shill_score_b, r.pair_type) for r in found] == [("a", "b", 80, None, "embedding")]
