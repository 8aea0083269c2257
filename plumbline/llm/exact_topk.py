"""Exact top-k search by vector-approximation files.

Distinct integer vectors are packed into blocks of ``BLOCK`` with a grid per dimension, ``CELLS`` cells between the
least and the largest value of the block, and the cell numbers of its vectors: the approximation file, an eighth of
the vectors. A scan of the cells gives for every query and vector bounds of the score, which are the score of the
cell's centre plus or minus the query's weight times half a cell.

1. All blocks of queries meet all blocks of cells. For each query a block reports its best lower bounds and its best
   upper bound. The k-th best lower bound of a query over all blocks is reached by k vectors, so nothing below it counts.
2. Only blocks whose best upper bound reaches that limit go on. There the exact vectors are read in the order of their
   bounds until the next bound lies below the k-th score found. The best of all blocks are the result.

Queries and vectors meet in explicit pairs of blocks: that is every query against every row, in pieces of bounded size.

Vectors that are equal after scaling count once; each carries the smallest ``k + 1`` of its ids, which is all that a
result of k can need, as ties go to the smaller id. So a vector that a third of all rows share is one entry.

Defined results: components become floor(scale * x) in double precision, kept as doubles, which hold them exactly.
Vectors that are null or hold null or non-finite components, and rows without id, take no part. Empty vectors
score 0 with each other. A score outside 64 bits counts as the nearest 64-bit integer, and a component
beyond 1e150 after scaling as 1e150. A query meets vectors of its own length only. A repeated id with one vector is one candidate; with several vectors it is one candidate
each, and as a query it is asked with each. All vectors but the query's own id are candidates. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm import common

BLOCK = 2048
QUERY_BLOCK = 512
CELLS = 16
SCALE = 256
#: Components of larger size count as this; no sum of products of two such overflows a double.
LARGEST = 1e150
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53
LONG = 2**63
#: Exact vectors read at a time.
STEP = 16


def integers(embedding: Column, scale: int = SCALE) -> Column:
    """The integer vector as binary (little-endian doubles), null where the row takes no part."""

    @F.pandas_udf("binary")
    def pack(column):
        array = pa.array(column, pa.list_(pa.float64()))
        out, flat, ends = [], pc.list_flatten(array), array.offsets.to_numpy()
        values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(values * scale)
        good = np.isfinite(values)
        whole = np.clip(np.where(good, scaled, 0), -LARGEST, LARGEST).astype("<f8") + 0.0  # no negative zero
        for i, valid in enumerate(array.is_valid().to_pylist()):
            s, e = (ends[i], ends[i + 1]) if valid else (0, 0)
            out.append(whole[s:e].tobytes() if valid and good[s:e].all() else None)
        return pa.array(out, pa.binary()).to_pandas()

    return pack(embedding.cast("array<double>"))


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)


def _scores(rows: np.ndarray, q: np.ndarray) -> list[int]:
    """Exact inner products of whole numbers held as doubles, kept within 64 bits."""
    if len(q) * np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) < EXACT:
        return (rows @ q).astype(np.int64).tolist()
    own = [int(x) for x in q]
    sums = (sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in rows.tolist())
    return [max(-LONG, min(LONG - 1, x)) for x in sums]


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids) of ``rows`` (id, vec): each distinct vector once with its smallest k + 1 ids.

    A task first keeps k + 1 ids of each vector it has seen, so that a hot vector sends that many rows per task.
    """

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[bytes, list[int]] = {}
            for i, vec in sorted(set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))):
                ids = least.setdefault(vec, [])
                if len(ids) <= k:
                    ids.append(i)
            flat = [(i, vec) for vec, ids in least.items() for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in flat], pa.int64()), pa.array([v for _, v in flat], pa.binary())], ["id", "vec"])

    slim = rows.mapInArrow(first, "id long, vec binary")
    order = W.partitionBy("vec").orderBy("id")
    return slim.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _numbered(rows: DataFrame, size: int, label: str) -> DataFrame:
    """``rows`` with (dim, block): blocks of about ``size`` vectors of one length, dealt by hash."""
    rows = rows.withColumn("dim", (F.length("vec") / 8).cast("int"))
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return rows.join(sizes, "dim").withColumn(label, F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int")).drop("blocks")


def top_k(vectors: DataFrame, queries: Column, *, k: int = 5, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row for which ``queries`` holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("vec"), queries.alias("asked"))
    rows = common.kept(rows.filter("id is not null and vec is not null"), "vectors")
    base = _numbered(distinct_vectors(rows.select("id", "vec"), k), BLOCK, "block")
    asked = _numbered(rows.filter("asked").select("id", "vec").distinct(), QUERY_BLOCK, "part")

    def lists(frame: DataFrame, label: str, keys: str) -> DataFrame:
        """One row per block, at most about twice its nominal size."""
        each = F.struct(F.col(keys), F.col("vec"))
        grouped = frame.groupBy("dim", label).agg(F.sort_array(F.collect_list(each)).alias("each"))
        return grouped.select("dim", label, F.col(f"each.{keys}").alias(keys), F.col("each.vec").alias(f"{label}_vec"))

    def approximate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, block, vecs in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                x = _matrix(vecs, dim)
                low, high = x.min(axis=0), x.max(axis=0)
                width = np.maximum((high - low) / CELLS, 1e-9)
                cells = np.minimum(((x - low) / width).astype(np.uint8), CELLS - 1)
                packed = np.concatenate([cells.ravel(), np.zeros(cells.size % 2, np.uint8)])
                packed = (packed[::2] | packed[1::2] << 4).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.int32()) for v in (dim, block, len(vecs))] + [pa.array([np.stack([low, width]).tobytes()]), pa.array([packed])],
                    ["dim", "block", "size", "grid", "cells"],
                )

    blocks = common.kept(lists(base, "block", "ids"), "blocks")
    cells = common.kept(blocks.mapInArrow(approximate, "dim int, block int, size int, grid binary, cells binary"), "cells")
    parts = common.kept(lists(asked, "part", "id").withColumnRenamed("id", "query_ids"), "queries")
    # Every block of queries meets every block of vectors of the same length, dealt out pair by pair.
    numbers = parts.groupBy("dim").agg(F.collect_set("part").alias("parts"))
    meet = cells.join(numbers, "dim").select("*", F.explode("parts").alias("part")).drop("parts")

    def centres(dim: int, size: int, grid: bytes, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        low, width = np.frombuffer(grid, np.float64).reshape(2, dim)
        both = np.frombuffer(packed, np.uint8)
        numbers_ = np.stack([both & 15, both >> 4], axis=1).ravel()[: size * dim].reshape(size, dim)
        return low + (numbers_ + 0.5) * width, width / 2

    def bounds(q: np.ndarray, centre: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible scores; the last term covers rounding."""
        middle = q @ centre.T
        off = np.abs(q) @ half + 1e-6 * (1 + np.abs(q) @ np.abs(centre).max(axis=0))
        return np.clip(middle - off[:, None], -LONG, LONG), np.clip(middle + off[:, None], -LONG, LONG)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = _matrix(row["part_vec"], row["dim"])
                low, high = bounds(q, *centres(row["dim"], row["size"], row["grid"], row["cells"]))
                best = high.max(axis=1)
                # A query may meet itself, and nothing else may hold one vector: the k + 1st best is reached by k others.
                at = max(0, low.shape[1] - k - 1)
                lows = np.partition(low, at, axis=1)[:, at:]
                n, m = lows.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["dim"]] * n, pa.int32()), pa.array([row["part"]] * n, pa.int32()), pa.array(np.arange(n), pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(best)]
                    + [pa.array(lows.tolist(), pa.list_(pa.float64()))],
                    ["dim", "part", "at", "block", "best", "lows"],
                )

    met = meet.join(parts.select("dim", "part", "part_vec"), ["dim", "part"]).repartition("dim", "part", "block")
    seen = common.kept(met.mapInArrow(scan, "dim int, part int, at int, block int, best double, lows array<double>"), "bounds")
    ranked = seen.select("dim", "part", "at", F.explode("lows").alias("low"))
    ranked = ranked.withColumn("r", F.row_number().over(W.partitionBy("dim", "part", "at").orderBy(F.desc("low"))))
    limits = ranked.filter(F.col("r") == k + 1).select("dim", "part", "at", F.col("low").alias("limit"))
    chosen = seen.join(limits, ["dim", "part", "at"], "left").filter("limit is null or best >= limit")
    chosen = chosen.groupBy("dim", "part", "block").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("limit", F.lit(float("-inf"))).alias("limit")))).alias("who"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, found = row["dim"], []
                exact = _matrix(row["block_vec"], dim)
                centre, half = centres(dim, row["size"], row["grid"], row["cells"])
                who = [w["at"] for w in row["who"]]
                queries_ = _matrix(row["part_vec"], dim)[who]
                _, highs = bounds(queries_, centre, half)
                for q, high, own, w in zip(queries_, highs, who, row["who"], strict=True):
                    name, top, limit = row["query_ids"][own], [], w["limit"]
                    order = np.argsort(-high, kind="stable")
                    order = order[high[order] >= limit]
                    for s in range(0, len(order), STEP):
                        if high[order[s]] < limit:
                            break
                        rows_ = order[s : s + STEP]
                        for score, r in zip(_scores(exact[rows_], q), rows_, strict=True):
                            top += [(-score, i) for i in row["ids"][r] if i != name]
                        top = sorted(top)[:k]
                        limit = max(limit, -top[-1][0]) if len(top) == k else limit
                    found += [(name, i, -score, dim) for score, i in top]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 3 + [pa.int32()], strict=True)], ["query_id", "vec_id", "score", "dim"])

    work = chosen.join(parts, ["dim", "part"]).join(cells, ["dim", "block"]).join(blocks, ["dim", "block"]).repartition("dim", "part", "block")
    hits = work.mapInArrow(search, "query_id long, vec_id long, score long, dim int")
    best = W.partitionBy("query_id", "dim").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
