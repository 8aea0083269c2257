"""Stores that share templates or near-identical reviews.

Reviews are first put into groups: one per template id, or one per distinct
vector. Edge weights come from per-store counts of a group, so no review pair is
ever listed for them: a group with n_a reviews in store a and n_b in store b adds
n_a * n_b. Listing the pairs themselves is a separate step for those who want it.

Both steps pair a group's members with ``_pair_up``. It cuts groups into chunks of
about ``chunk_rows`` members and pairs chunk with chunk, one pair to a task's key,
so that no task receives a whole hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.constants import SCORE_THRESHOLD, STORE_PAIR_DISTANCE_THRESHOLD, UNLISTED_TEMPLATE
from plumbline.functions import vectors as V
from plumbline.operators.sizing import small_side
from plumbline.session import durable

CHUNK_ROWS = 2_000
BLOCK_ROWS = 4_096
MAX_PIVOTS = 256
# Vectors that the short basis is taken from, and its width.
SAMPLE_ROWS = 1_024
# Members of one vector that a row lists, rows compared at a time, and pairs made at a time.
HELD_ROWS = 16
SLICE_ROWS = 128
OUTPUT_ROWS = 1 << 16
SHORT_WIDTH = 32
# Covers the rounding of the slim rows to single precision.
SLACK = 1e-4


# -- members -----------------------------------------------------------------


def eligible(assessments: DataFrame, min_score: int = SCORE_THRESHOLD) -> DataFrame:
    """Confident assessments that name a listed template."""
    return assessments.where(
        F.col("template_detected")
        & F.col("template_id").isNotNull()
        & (F.col("template_id") != UNLISTED_TEMPLATE)
        & (F.col("shill_score") >= min_score)
    )


def template_members(assessments: DataFrame, run_id: str, min_score: int = SCORE_THRESHOLD) -> DataFrame:
    mine = assessments.where(F.col("pipeline_run_id") == run_id)
    return eligible(mine, min_score).select(
        F.col("template_id").alias("member_group"), "store_id", "review_id", "shill_score"
    )


def semantic_members(
    stage2: DataFrame,
    vectors: DataFrame,
    assessments: DataFrame,
    run_id: str,
    model: str,
    require_same_run: bool = True,
) -> DataFrame:
    """Stage-2 reviews with their unit vector; the group is the vector itself, so
    copies fall together. By default a vector made by an earlier run does not count."""
    usable = vectors.where((F.col("status") == "ok") & (F.col("embedding_model") == model))
    if require_same_run:
        usable = usable.where(F.col("pipeline_run_id") == run_id)
    mine = stage2.where(F.col("pipeline_run_id") == run_id).select("review_id", "store_id")
    scores = assessments.where(F.col("pipeline_run_id") == run_id).select("review_id", "shill_score")
    return (
        mine.join(usable.select("review_id", "embedding"), "review_id")
        .join(scores, "review_id", "left")
        .select("store_id", "review_id", "shill_score", V.keyed_unit("embedding").alias("v"))
        .select(F.col("v.vector_key").alias("member_group"), "store_id", "review_id", "shill_score", F.col("v.unit").alias("unit"))
    )


# -- matches between groups --------------------------------------------------


def same_group(members: DataFrame) -> DataFrame:
    """Every group matches itself."""
    one = members.select("member_group").distinct()
    return one.select(
        F.col("member_group").alias("group_a"),
        F.col("member_group").alias("group_b"),
        F.lit(None).cast("double").alias("cosine_distance"),
    )


def _partners(located: DataFrame, centre: np.ndarray, max_distance: float, block_rows: int) -> DataFrame:
    """(cell, first, blocks, partner_first, partner_blocks): which blocks can hold a match for a cell's vectors.

    Two cells can only hold a match if the angle between their pivots minus both cell radii is within the allowed angle
    (triangle inequality on the sphere). At most ``MAX_PIVOTS`` squared rows, whatever the number of vectors.
    """
    cells = located.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    radius = np.zeros(len(centre))
    blocks = np.zeros(len(centre), dtype=np.int64)
    for row in cells:
        radius[row.cell], blocks[row.cell] = row.radius, -(-row.n // block_rows)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    allowed = np.arccos(np.clip(1.0 - max_distance, -1.0, 1.0))
    apart = np.arccos(np.clip(centre @ centre.T, -1.0, 1.0))
    reachable = apart - radius[:, None] - radius[None, :] <= allowed + 1e-6
    np.fill_diagonal(reachable, True)
    reachable &= (blocks > 0)[:, None] & (blocks > 0)[None, :]
    rows = [(int(i), int(first[i]), int(blocks[i]), int(first[j]), int(blocks[j])) for i, j in zip(*np.nonzero(reachable))]
    return located.sparkSession.createDataFrame(rows, "cell int, first long, blocks long, partner_first long, partner_blocks long")


def block_pairs(distinct: DataFrame, max_distance: float, block_rows: int) -> DataFrame:
    """(id, block, low, high): which vectors of ``distinct`` (id, unit) have to meet in which pair of blocks.

    Each vector is first reduced to its part in a short orthonormal basis and the length of the rest. The rests of two
    unit vectors add at most the product of their lengths to their cosine, so the short parts bound the cosine from
    above. Only these slim rows are sent to every block within reach; a vector is listed for a pair of blocks if the
    other block holds one that the bound does not rule out. Nothing within ``max_distance`` is lost.
    """
    total = distinct.count()
    if total <= block_rows:
        # One block: all meet in it.
        number = lambda name: F.lit(0).cast("long").alias(name)
        return distinct.select("id", number("block"), number("low"), number("high"))
    # Keys are cryptographic hashes, so the smallest ones are a random sample of bounded size.
    sample = distinct.orderBy("member_group").limit(SAMPLE_ROWS).select("unit").collect()
    rows = np.array([row.unit for row in sample])
    centre = rows[: min(MAX_PIVOTS, max(1, -(-total // block_rows)))]
    basis = np.linalg.svd(rows, full_matrices=False)[2][:SHORT_WIDTH]

    @F.arrow_udf("struct<cell:int,angle:double,short:array<float>,rest:float>")
    def locate(units: pa.Array) -> pa.Array:
        matrix = V.as_matrix(units)
        if not len(matrix):
            matrix = np.zeros((0, centre.shape[1]))
        cosine = matrix @ centre.T
        cell = cosine.argmax(axis=1)
        angle = np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1.0, 1.0))
        short = matrix @ basis.T
        rest = np.sqrt(np.clip(1.0 - (short * short).sum(axis=1), 0.0, 1.0))
        offsets = pa.array(np.arange(len(short) + 1, dtype=np.int32) * len(basis))
        lists = pa.ListArray.from_arrays(offsets, pa.array(short.ravel().astype(np.float32)))
        columns = [pa.array(cell.astype(np.int32)), pa.array(angle), lists, pa.array(rest.astype(np.float32))]
        return pa.StructArray.from_arrays(columns, ["cell", "angle", "short", "rest"])

    located = durable(distinct.select("id", locate("unit").alias("at")).select("id", "at.*"))
    partners = _partners(located, centre, max_distance, block_rows)
    block = F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))
    partner = F.explode(F.sequence("partner_first", F.col("partner_first") + F.col("partner_blocks") - 1))
    placed = located.join(F.broadcast(partners), "cell").select("id", "short", "rest", block.alias("block"), partner.alias("partner"))
    placed = placed.select("id", "short", "rest", "block", F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))
    least = np.float32(1.0 - max_distance - SLACK)
    schema = pa.schema([("id", pa.int64()), ("block", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def screen(rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        block = rows["block"].to_numpy()
        short, rest = V.as_matrix(rows["short"]).astype(np.float32), rows["rest"].to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        meets = np.zeros(len(block), dtype=bool)
        for start in range(0, len(left), 512):
            some = left[start : start + 512]
            near = short[some] @ short[right].T + np.outer(rest[some], rest[right]) >= least
            if low == high:
                near[np.arange(len(some)), np.arange(start, start + len(some))] = False
            meets[some] |= near.any(axis=1)
            meets[right] |= near.any(axis=0)
        return rows.select(["id", "block", "low", "high"]).filter(pa.array(meets)).cast(schema)

    return placed.groupBy("low", "high").applyInArrow(screen, "id long, block long, low long, high long")


def similar_vectors(
    members: DataFrame,
    max_distance: float = STORE_PAIR_DISTANCE_THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All ordered pairs of distinct vectors at most ``max_distance`` apart, plus
    each vector with itself. Exact: nothing is sampled or hashed away.

    Vectors are assigned to their nearest of up to 256 pivots and the cells cut
    into blocks of about ``block_rows``. ``block_pairs`` finds on slim rows which
    vectors have to meet; only these are fetched, once for each pair of blocks,
    and each pair of blocks is one bounded matrix product.
    """
    keyed = members.select("member_group", "unit").dropDuplicates(["member_group"])
    distinct = durable(keyed.withColumn("id", F.monotonically_increasing_id()))
    itself = distinct.select(
        F.col("member_group").alias("group_a"),
        F.col("member_group").alias("group_b"),
        F.lit(0.0).alias("cosine_distance"),
    )
    # A vector of length zero has no direction and matches itself alone.
    usable = distinct.where(~F.isnan(F.get("unit", 0)))
    placed = block_pairs(usable, max_distance, block_rows).join(usable, "id")

    names = ["group_a", "group_b", "cosine_distance"]
    schema = pa.schema([(names[0], pa.string()), (names[1], pa.string()), (names[2], pa.float64())])

    def compare(rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        of = lambda b: rows.filter(pa.compute.equal(rows["block"], b))
        left, right = of(low), of(high)
        found = []
        if left.num_rows and right.num_rows:
            keys_a, keys_b = left["member_group"].combine_chunks(), right["member_group"].combine_chunks()
            unit_a, unit_b = V.as_matrix(left["unit"]), V.as_matrix(right["unit"])
            for start in range(0, len(unit_a), 512):
                distance = V.distances(unit_a[start : start + 512], unit_b)
                hit_a, hit_b = np.nonzero(distance <= max_distance)
                if low == high:
                    once = hit_a + start < hit_b
                    hit_a, hit_b = hit_a[once], hit_b[once]
                a, b = keys_a.take(pa.array(hit_a + start)), keys_b.take(pa.array(hit_b))
                apart = pa.array(distance[hit_a, hit_b])
                found += [pa.table([x, y, apart], names=names) for x, y in ((a, b), (b, a))]
        return pa.concat_tables([schema.empty_table(), *(t.cast(schema) for t in found)])

    found = placed.groupBy("low", "high").applyInArrow(compare, "group_a string, group_b string, cosine_distance double")
    return found.unionByName(itself)


# -- pairs of similar vectors, where they are found ----------------------------


def _vector_rows(members: DataFrame, held: list[str], chunk_by: str, chunk_rows: int) -> DataFrame:
    """(id, member_group, unit, held): a row for each about ``chunk_rows`` members of a vector, which it lists."""
    sizes = members.groupBy("member_group").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    chunk = F.coalesce(F.pmod(F.xxhash64(chunk_by), "chunks").cast("int"), F.lit(0)).alias("chunk")
    rows = (
        members.join(small_side(sizes.where("chunks > 1")), "member_group", "left")
        .groupBy("member_group", chunk)
        .agg(F.first("unit").alias("unit"), F.collect_list(F.struct(*held)).alias("held"))
    )
    return durable(rows.select(F.monotonically_increasing_id().alias("id"), "member_group", "unit", "held"))


def _spread_hits(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hit, place in a, place in b) of every pair of members of every hit, about ``OUTPUT_ROWS`` pairs at a time."""
    pairs = sizes_a * sizes_b
    piece = np.cumsum(pairs) // OUTPUT_ROWS
    for own in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(piece)) + 1):
        hit = np.repeat(own, pairs[own])
        at = np.arange(len(hit)) - np.repeat(np.cumsum(pairs[own]) - pairs[own], pairs[own])
        yield hit, at // sizes_b[hit], at % sizes_b[hit]


def _member_pairs(
    members: DataFrame, held: list[str], chunk_by: str, max_distance: float, block_rows: int, chunk_rows: int,
    shown: Callable[[pa.StructArray, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch], schema: str,
) -> tuple[DataFrame, DataFrame]:
    """What ``shown`` makes of all pairs of ``members`` from different stores whose vectors match: it is given the
    members that meet in a task, the places of either side's, smaller store first, and their distances.

    Vectors bring their members along, so pairs are made where matches are found and no list of matches is shuffled.
    Pairs within one row are not among them; the rows are returned too.
    """
    rows = _vector_rows(members, held, chunk_by, chunk_rows)
    placed = block_pairs(rows, max_distance, block_rows).join(rows, "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        block = table["block"].to_numpy()
        vector = table["member_group"].combine_chunks().dictionary_encode().indices.to_numpy()
        unit, lists = V.as_matrix(table["unit"]), table["held"].combine_chunks()
        sizes, every = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten()
        first = np.cumsum(sizes) - sizes
        stores = every.field("store_id").to_pylist()
        rank = {s: i for i, s in enumerate(sorted({s for s in stores if s is not None}))}
        store = np.array([rank.get(s, -1) for s in stores], dtype=np.int64)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for start in range(0, len(left), SLICE_ROWS):
            some = left[start : start + SLICE_ROWS]
            distance = V.distances(unit[some], unit[right])
            hit_a, hit_b = np.nonzero(distance <= max_distance)
            if low == high:
                once = hit_a + start < hit_b
                hit_a, hit_b = hit_a[once], hit_b[once]
            if not len(hit_a):
                continue
            apart = distance[hit_a, hit_b]
            i, j = some[hit_a], right[hit_b]
            apart[vector[i] == vector[j]] = 0.0
            for hit, at_a, at_b in _spread_hits(sizes[i], sizes[j]):
                a, b = first[i[hit]] + at_a, first[j[hit]] + at_b
                fit = (store[a] != store[b]) & (store[a] >= 0) & (store[b] >= 0)
                a, b, hit = a[fit], b[fit], hit[fit]
                turned = store[a] > store[b]
                a, b = np.where(turned, b, a), np.where(turned, a, b)
                if len(a):
                    yield shown(every, a, b, apart[hit])

    return placed.groupBy("low", "high").applyInArrow(compare, schema), rows


def _within(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of members from different stores that one row lists, smaller store first."""
    first = rows.where(F.size("held") > 1).select("held", F.posexplode("held").alias("at", "a"))
    both = first.select("a", F.explode(F.slice("held", F.col("at") + 2, F.size("held"))).alias("b"))
    turned = F.col("a.store_id") > F.col("b.store_id")
    return both.where("a.store_id <> b.store_id").select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b")
    )


def _directed(members: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Members with a vector that has a direction, and the others, None if there are none. The latter match their own copies alone."""
    lost = members.where(F.isnan(F.get("unit", 0)))
    return members.where(~F.isnan(F.get("unit", 0))), None if lost.isEmpty() else lost


_PAIR_COLUMNS = ["store_id", "review_id", "shill_score"]


def similar_pairs(
    members: DataFrame,
    max_distance: float = STORE_PAIR_DISTANCE_THRESHOLD,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = HELD_ROWS,
) -> DataFrame:
    """``collision_pairs`` of ``similar_vectors``, which are never listed: every pair is written where it is found."""
    names = [f"{c}_{s}" for c in _PAIR_COLUMNS for s in "ab"]
    kinds = {c: members.schema[c].dataType.simpleString() for c in _PAIR_COLUMNS}
    schema = ", ".join([*(f"{n} {kinds[n[:-2]]}" for n in names), "cosine_distance double"])

    def shown(every: pa.StructArray, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
        of = {"a": pa.array(a), "b": pa.array(b)}
        columns = [every.field(n[:-2]).take(of[n[-1]]) for n in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(apart)], names=[*names, "cosine_distance"])

    usable, lost = _directed(members.select("member_group", "unit", *_PAIR_COLUMNS))
    across, rows = _member_pairs(usable, _PAIR_COLUMNS, "review_id", max_distance, block_rows, chunk_rows, shown, schema)
    within = _within(rows).select(*[F.col(f"{n[-1]}.{n[:-2]}").alias(n) for n in names], F.lit(0.0).alias("cosine_distance"))
    found = across.unionByName(within).select(
        "store_id_a", "store_id_b", "review_id_a", "review_id_b", F.lit(None).cast("string").alias("template_id"),
        "cosine_distance", "shill_score_a", "shill_score_b", F.lit("embedding").alias("pair_type"),
    )
    if lost is None:
        return found
    copies = same_group(lost).withColumn("cosine_distance", F.lit(0.0))
    return found.unionByName(collision_pairs(lost, copies, "embedding"))


def similar_store_counts(
    members: DataFrame,
    max_distance: float = STORE_PAIR_DISTANCE_THRESHOLD,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = HELD_ROWS,
) -> DataFrame:
    """``store_pair_counts`` of ``similar_vectors``: pairs are counted by stores where matches are found."""
    schema = "store_id_a string, store_id_b string, n_pairs long"

    def shown(every: pa.StructArray, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
        n = every.field("n").to_numpy()
        ids = every.field("store_id").dictionary_encode()
        code = ids.indices.fill_null(0).to_numpy().astype(np.int64)
        both, place = np.unique(code[a] * len(ids.dictionary) + code[b], return_inverse=True)
        total = np.zeros(len(both), dtype=np.int64)
        np.add.at(total, place, n[a] * n[b])
        sides = [ids.dictionary.take(pa.array(x)) for x in np.divmod(both, len(ids.dictionary))]
        return pa.RecordBatch.from_arrays([*sides, pa.array(total)], names=["store_id_a", "store_id_b", "n_pairs"])

    usable, lost = _directed(members)
    counts = usable.groupBy("member_group", "store_id").agg(F.count("*").alias("n"), F.first("unit").alias("unit"))
    across, rows = _member_pairs(counts, ["store_id", "n"], "store_id", max_distance, block_rows, chunk_rows, shown, schema)
    within = _within(rows).select(F.col("a.store_id").alias("store_id_a"), F.col("b.store_id").alias("store_id_b"), (F.col("a.n") * F.col("b.n")).alias("n_pairs"))
    found = across.unionByName(within)
    if lost is not None:
        found = found.unionByName(store_pair_counts(lost, same_group(lost), "embedding").select("store_id_a", "store_id_b", "n_pairs"))
    return found.groupBy("store_id_a", "store_id_b", F.lit(None).cast("string").alias("template_id")).agg(
        F.sum("n_pairs").alias("n_pairs")
    ).withColumn("pair_type", F.lit("embedding"))


# -- pairing -----------------------------------------------------------------


def _pair_up(members: DataFrame, matches: DataFrame, chunk_by: str, chunk_rows: int) -> DataFrame:
    """Members of matching groups from different stores, ``store_id_a < store_id_b``.

    A group of n members is cut into n / ``chunk_rows`` chunks by hash. Every member
    goes once to each chunk of the matching group, and both sides meet in a single
    join on the two groups and the two chunks. A task therefore pairs at most about
    ``chunk_rows`` members with as many others, however hot a group is.
    """
    chunks = members.groupBy("member_group").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    grid = matches
    for s in ("a", "b"):
        grid = grid.join(chunks.withColumnsRenamed({"member_group": f"group_{s}", "chunks": f"chunks_{s}"}), f"group_{s}")

    def side(s: str, other: str) -> DataFrame:
        named = members.withColumn("own", F.xxhash64(chunk_by)).withColumnRenamed("member_group", "group")
        named = named.withColumnsRenamed({c: f"{c}_{s}" for c in named.columns}).join(grid, f"group_{s}")
        mine = F.pmod(f"own_{s}", f"chunks_{s}").cast("int").alias(f"chunk_{s}")
        theirs = F.explode(F.sequence(F.lit(0), F.col(f"chunks_{other}") - 1)).alias(f"chunk_{other}")
        return named.select("*", mine, theirs).drop("chunks_a", "chunks_b", f"own_{s}")

    left, right = side("a", "b"), side("b", "a").drop("cosine_distance")
    return left.join(right, ["group_a", "group_b", "chunk_a", "chunk_b"]).where("store_id_a < store_id_b")


def store_pair_counts(
    members: DataFrame, matches: DataFrame, pair_type: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Review pairs per store pair and template, counted without listing them."""
    counts = members.groupBy("member_group", "store_id").agg(F.count("*").alias("n"))
    template = F.col("group_a") if pair_type == "template" else F.lit(None).cast("string")
    return (
        _pair_up(counts, matches, "store_id", chunk_rows)
        .groupBy("store_id_a", "store_id_b", template.alias("template_id"))
        .agg(F.sum(F.col("n_a") * F.col("n_b")).alias("n_pairs"))
        .withColumn("pair_type", F.lit(pair_type))
    )


def collision_pairs(
    members: DataFrame, matches: DataFrame, pair_type: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Every colliding review pair. The result grows with the square of a group,
    so this is for drill-down; edges do not need it."""
    slim = members.select("member_group", "store_id", "review_id", "shill_score")
    template = F.col("group_a") if pair_type == "template" else F.lit(None).cast("string")
    return _pair_up(slim, matches, "review_id", chunk_rows).select(
        "store_id_a",
        "store_id_b",
        "review_id_a",
        "review_id_b",
        template.alias("template_id"),
        "cosine_distance",
        "shill_score_a",
        "shill_score_b",
        F.lit(pair_type).alias("pair_type"),
    )


def template_collisions(assessments: DataFrame, run_id: str, min_score: int = SCORE_THRESHOLD) -> DataFrame:
    members = template_members(assessments, run_id, min_score)
    return collision_pairs(members, same_group(members), "template")


def semantic_collisions(
    stage2: DataFrame,
    vectors: DataFrame,
    assessments: DataFrame,
    run_id: str,
    model: str,
    max_distance: float = STORE_PAIR_DISTANCE_THRESHOLD,
    require_same_run: bool = True,
) -> DataFrame:
    members = durable(semantic_members(stage2, vectors, assessments, run_id, model, require_same_run))
    return similar_pairs(members, max_distance)


# -- edges -------------------------------------------------------------------


def edges_from_counts(counts: DataFrame) -> DataFrame:
    """Store graph: weight is the number of colliding pairs of either kind."""
    return counts.groupBy(
        F.col("store_id_a").alias("src_store_id"), F.col("store_id_b").alias("dst_store_id")
    ).agg(
        F.sum("n_pairs").alias("weight"),
        F.sort_array(F.collect_set("template_id")).alias("template_ids"),
    )


def edges_from_pairs(pairs: DataFrame) -> DataFrame:
    """The same graph from listed pairs."""
    return edges_from_counts(pairs.withColumn("n_pairs", F.lit(1).cast("long")))


def top_edges(edges: DataFrame) -> DataFrame:
    return edges.orderBy(F.desc("weight"), "src_store_id", "dst_store_id")
