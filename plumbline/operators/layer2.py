"""Distance of each review to its nearest seed phrase."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.constants import SEED_DISTANCE_THRESHOLD
from plumbline.functions import vectors as V

# Seeds are kept by hand (seven slots per version); a task holds one block of them as a matrix at a time.
SEEDS_PER_BLOCK = 1024
# Bits of the filter that leaves out vectors of other runs, 16 MB at most, and the hash bits it looks at.
FILTER_BITS = 1 << 27
FILTER_SHIFTS = (0, 20, 37)
_NEAREST = "struct<min_cosine_distance:double,matched_seed_id:string,matched_seed_category:string>"


def active_seeds(seed_vectors: DataFrame, seeds: DataFrame, version: str, model: str) -> DataFrame:
    """Vectors of the seeds that are active in ``version``."""
    wanted = seeds.where((F.col("seed_version") == version) & F.col("is_active")).select("seed_id")
    return seed_vectors.where(
        (F.col("seed_version") == version) & (F.col("embedding_model") == model)
    ).join(wanted, "seed_id", "left_semi")


def _closest(matrix: np.ndarray, seeds: list[tuple[str, str]], unit_seeds: np.ndarray) -> pa.StructArray:
    """Nearest seed per row; seeds come sorted by id, so the first minimum wins ties."""
    distance = V.distances(V.unit_rows(matrix), unit_seeds)
    best = distance.argmin(axis=1)
    return pa.StructArray.from_arrays(
        [
            pa.array(distance[np.arange(len(best)), best]),
            pa.array([seeds[i][0] for i in best], pa.string()),
            pa.array([seeds[i][1] for i in best], pa.string()),
        ],
        ["min_cosine_distance", "matched_seed_id", "matched_seed_category"],
    )


def _nearest_of(rows: list) -> Column:
    names = [(r.seed_id, r.category) for r in rows]
    unit_seeds = V.unit_rows(np.array([r.embedding for r in rows], dtype=np.float64))

    @F.arrow_udf(_NEAREST)
    def nearest(embeddings: pa.Array) -> pa.Array:
        matrix = V.as_matrix(embeddings)
        if not len(matrix):
            return _closest(np.zeros((0, unit_seeds.shape[1])), names, unit_seeds)
        return _closest(matrix, names, unit_seeds)

    return nearest(F.col("embedding"))


def nearest_seed(vectors: DataFrame, seeds: DataFrame, max_local: int = SEEDS_PER_BLOCK) -> DataFrame:
    """``(review_id, min_cosine_distance, matched_seed_id, matched_seed_category)``,
    one row per review; ties go to the smaller seed id.

    Distances are taken right at the scan, one block of at most ``max_local`` seeds
    after the other, so the wide vectors are neither copied nor shuffled; only the
    small winners are.
    """
    rows = sorted(seeds.select("seed_id", "category", "embedding").collect(), key=lambda r: r.seed_id)
    if not rows:
        raise ValueError("no active seed vectors")
    best = [_nearest_of(rows[i : i + max_local]) for i in range(0, len(rows), max_local)]
    # A struct compares by distance, then by seed id.
    scored = vectors.select("review_id", (best[0] if len(best) == 1 else F.least(*best)).alias("best"))
    return (
        scored.groupBy("review_id")
        .agg(F.min("best").alias("best"))
        .select("review_id", "best.*")
    )


def among(rows: DataFrame, ids: DataFrame, key: str = "review_id") -> DataFrame:
    """``rows`` but for most of those whose ``key`` is not in ``ids``: a Bloom filter of at most ``FILTER_BITS`` bits.

    The filter is made by one aggregation and tested on a hash of the key, so wide rows are left out where they are
    read, whatever the number of ids. It lets some others pass, ever more beyond a tenth of ``FILTER_BITS`` ids; what
    follows must join the ids anyway.
    """
    hashed = F.xxhash64(key)
    places = F.array(*(F.shiftrightunsigned(hashed, by).bitwiseAND(F.lit(FILTER_BITS - 1)) for by in FILTER_SHIFTS))
    words = ids.select(F.explode(places).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    ).toArrow()
    # Few ids need few bits: the filter is folded to about ten bits for each.
    bits = min(FILTER_BITS, max(64, 1 << (10 * words.num_rows // len(FILTER_SHIFTS)).bit_length()))
    table = np.zeros(bits // 64, dtype=np.uint64)
    np.bitwise_or.at(table, words["word"].to_numpy() % len(table), words["bits"].to_numpy().view(np.uint64))

    @F.arrow_udf("boolean")
    def may_be_in(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        hit = np.ones(len(h), dtype=bool)
        for by in FILTER_SHIFTS:
            at = (h >> np.uint64(by)) & np.uint64(bits - 1)
            hit &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return pa.array(hit)

    return rows.where(may_be_in(hashed))


def distance_audit(
    stage1: DataFrame,
    vectors: DataFrame,
    seeds: DataFrame,
    run_id: str,
    model: str,
    threshold: float = SEED_DISTANCE_THRESHOLD,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Nearest seed of every stage-1 review of a run that has a usable vector.

    Vectors are reused across runs on purpose: only stage 1 is tied to the run. Those of
    other reviews are left out before a distance is taken; ``candidates`` lists all ids of
    stage 1, and maybe more, where that is cheaper than stage 1 itself.
    ``comment_text`` is along for stage 2 and is pruned where not selected.
    """
    usable = vectors.where((F.col("status") == "ok") & (F.col("embedding_model") == model))
    mine = stage1.where(F.col("pipeline_run_id") == run_id)
    wanted = among(usable.select("review_id", "embedding"), (mine if candidates is None else candidates).select("review_id"))
    nearest = nearest_seed(wanted, seeds)
    return mine.join(nearest, "review_id").select(
        "pipeline_run_id",
        "review_id",
        "store_id",
        "product_id",
        "comment_text",
        "review_ts",
        "matched_seed_id",
        "matched_seed_category",
        "min_cosine_distance",
        V.cosine_similarity(F.col("min_cosine_distance")).alias("min_cosine_similarity"),
        F.lit(float(threshold)).alias("threshold"),
    )


def l2_filter(audit: DataFrame, threshold: float = SEED_DISTANCE_THRESHOLD) -> DataFrame:
    """Stage 2: reviews at most ``threshold`` away from a seed."""
    return audit.where(F.col("min_cosine_distance") <= threshold)


def l2_funnel(stage1: DataFrame, vectors: DataFrame, stage2: DataFrame, model: str) -> DataFrame:
    """Stage-1, vector and stage-2 counts of a run. A review with several error
    vectors counts once for each, as stored."""
    states = vectors.where(F.col("embedding_model") == model).select("review_id", "status")
    joined = stage1.select("review_id").join(states, "review_id", "left")
    counts = joined.agg(
        F.count_if(F.col("status") == "ok").alias("n_embedded_ok"),
        F.count_if(F.col("status") == "error").alias("n_embedded_err"),
    )
    return counts.withColumn("n_stage1", stage1.agg(F.count("*")).scalar()).withColumn(
        "n_suspicious", stage2.agg(F.count("*")).scalar()
    )


def closest(stage2: DataFrame, n: int = 10) -> DataFrame:
    return (
        stage2.orderBy("min_cosine_distance", "review_id")
        .limit(n)
        .select(
            "review_id",
            "matched_seed_id",
            "matched_seed_category",
            "min_cosine_distance",
            "min_cosine_similarity",
        )
    )


def layer2_gates(seeds: DataFrame, stage1: DataFrame, vectors: DataFrame, model: str) -> None:
    """Stop a run that cannot give distances: no active seed, or reviews without any vector."""
    if seeds.isEmpty():
        raise ValueError("no active seeds")
    ok = vectors.where((F.col("status") == "ok") & (F.col("embedding_model") == model))
    if not stage1.isEmpty() and ok.join(stage1.select("review_id"), "review_id", "left_semi").isEmpty():
        raise ValueError("stage 1 has reviews but none has a usable vector")
