"""Search results against all scores."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from plumbline.llm import exact_topk


def plain(rows, every, k=5):
    ints = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in ints:
        if q % every:
            continue
        inner = lambda y: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y, strict=True))))  # noqa: E731,B023
        scores = {(-inner(y), i) for i, y in ints if i != q and len(x) == len(y)}
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_equals_all_scores(spark):
    random.seed(3)
    gauss = lambda n: [random.gauss(0, 0.2) for _ in range(n)]
    rows = [(i, gauss(8)) for i in range(300)] + [(300 + i, [0.25] * 8) for i in range(200)] + [(500 + i, gauss(3)) for i in range(12)]
    rows += [(600, None), (605, []), (610, [None] + gauss(7)), (615, [float("nan")] * 8), (620, [float("inf")] + gauss(7)), (None, gauss(8)), (625, gauss(5)), (5, [0.25] * 8)]
    rows += [(0, rows[0][1]), (1, rows[1][1])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    from numpy import float32

    want = plain([(i, v and [None if x is None else float(float32(x)) for x in v]) for i, v in rows], 5)
    got = exact_topk.top_k(vectors, F.col("vec_id") % 5 == 0).collect()
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] != 5}
    assert got == {w for w in want if w[0] != 5}


def test_large_components_and_empty_vectors(spark):
    random.seed(4)
    rows = [(0, [3e6, 4e6]), (1, [4e6, 3e6]), (2, [1.0, 2.0]), (50, [3e6, -4e6]), (51, []), (52, []), (100, [])]
    rows += [(200 + i, [random.choice([1, -1]) * random.uniform(1, 10) * 10 ** random.randint(-2, 11) for _ in range(6)]) for i in range(150)]
    rows += [(400, [1e30, 1.0]), (401, [1e300, -1e308]), (402, [-0.0, 0.0]), (403, [0.0, -0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in exact_topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect()}
    assert {(100, 1, 51, 0), (100, 2, 52, 0), (0, 1, 400, 2**63 - 1)} <= got
    want = plain([(i, [max(-1e150, min(1e150, 256 * x)) / 256 for x in v]) for i, v in rows], 50)
    assert got == want


def test_empty_table_and_no_queries(spark):
    vectors = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(vectors, F.col("vec_id") > 9).collect() == []
    assert exact_topk.top_k(vectors.limit(0), F.col("vec_id") > 0).collect() == []
    assert [tuple(r) for r in exact_topk.top_k(vectors, F.col("vec_id") == 1).collect()] == [(1, 1, 2, 256 * 512)]
