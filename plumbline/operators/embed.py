"""Review and seed vectors: which are missing, which are stale, how to fill them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from plumbline.functions import text, vectors as V

# An embedder takes the texts of one Arrow batch and returns a vector (or None)
# and an error text (or "") for each.
Embedder = Callable[[list[str]], tuple[list, list[str]]]

TASK = "SEMANTIC_SIMILARITY"


class HashedTrigrams:
    """Offline stand-in for a remote model: counts of character trigrams in
    ``width`` hash cells, scaled to length one. Whole texts, any language."""

    def __init__(self, width: int = 256):
        self.width = width

    def __call__(self, texts: list[str]) -> tuple[list, list[str]]:
        out, problems = [], []
        for value in texts:
            points = np.frombuffer((value or "").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
            if len(points) < 3:
                out.append(None)
                problems.append("text too short")
                continue
            cells = (points[:-2] * 961 + points[1:-1] * 31 + points[2:]) % self.width
            counts = np.bincount(cells, minlength=self.width).astype(np.float64)
            out.append(counts / np.linalg.norm(counts))
            problems.append("")
        return out, problems


def stale_vectors(vectors: DataFrame, stage1: DataFrame, model: str) -> DataFrame:
    """(review_id, embedding_model, content_hash) of the vectors whose review text has changed since."""
    current = stage1.select("review_id", F.col("content_hash").alias("current_hash"))
    mine = vectors.where(F.col("embedding_model") == model).select("review_id", "embedding_model", "content_hash")
    return mine.join(current, "review_id").where("content_hash <> current_hash").drop("current_hash").distinct()


def drop_stale_vectors(vectors: DataFrame, stage1: DataFrame, model: str) -> DataFrame:
    """Vectors without those whose review text has changed since."""
    current = stage1.select("review_id", F.col("content_hash").alias("current_hash"))
    changed = (
        (F.col("v.review_id") == F.col("s.review_id"))
        & (F.col("v.content_hash") != F.col("s.current_hash"))
        & (F.col("v.embedding_model") == model)
    )
    return vectors.alias("v").join(current.alias("s"), changed, "left_anti")


def embed_pending(stage1: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """Reviews that have no usable vector of this model from any run."""
    done = vectors.where((F.col("embedding_model") == model) & (F.col("status") == "ok"))
    return stage1.join(done.select("review_id"), "review_id", "left_anti")


def run_embedder(df: DataFrame, text_column: str, embedder: Embedder) -> DataFrame:
    """``df`` plus ``embedding`` (empty, never NULL, on failure) and ``status_detail``."""
    kept = [c for c in df.columns if c != text_column]
    schema = df.select(*kept).schema.add("embedding", ArrayType(DoubleType())).add("status_detail", StringType())

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, problems = embedder(batch.column(text_column).to_pylist())
            lists = [[] if v is None else v for v in found]
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array(lists, pa.list_(pa.float64())))
            columns.append(pa.array([p or None for p in problems], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "embedding", "status_detail"])

    return df.select(*kept, text_column).mapInArrow(embed, schema)


def embed_missing(
    stage1: DataFrame,
    vectors: DataFrame,
    embedder: Embedder,
    model: str,
    run_id: str,
    char_cap: int | None = None,
) -> DataFrame:
    """New vector rows for the pending reviews of a run, failures included.

    ``char_cap`` is only for models with a fixed input window; by default the
    whole text is embedded.
    """
    content = F.col("comment_text") if char_cap is None else text.cap_text(F.col("comment_text"), char_cap)
    pending = embed_pending(stage1, vectors, model).select(
        "review_id", "store_id", "product_id", "content_hash", content.alias("content")
    )
    made = run_embedder(pending, "content", embedder)
    return made.select(
        F.lit(run_id).alias("pipeline_run_id"),
        "review_id",
        "store_id",
        "product_id",
        "content_hash",
        "embedding",
        F.lit(model).alias("embedding_model"),
        F.lit(TASK).alias("task_type"),
        V.vector_status(F.col("embedding"), F.col("status_detail")).alias("status"),
        "status_detail",
        F.current_timestamp().alias("embedded_at"),
    )


def embed_seeds(seeds: DataFrame, embedder: Embedder, model: str, version: str) -> DataFrame:
    """Vectors of the active seeds of one version; seeds that fail are left out."""
    wanted = seeds.where((F.col("seed_version") == version) & F.col("is_active"))
    made = run_embedder(wanted.select("seed_id", "category", "seed_text"), "seed_text", embedder)
    return made.where(F.size("embedding") > 0).select(
        F.lit(version).alias("seed_version"),
        "seed_id",
        "category",
        "embedding",
        F.lit(model).alias("embedding_model"),
        F.current_timestamp().alias("embedded_at"),
    )


def replace_seed_vectors(seed_vectors: DataFrame, rows: DataFrame, version: str, model: str) -> DataFrame:
    other = (F.col("seed_version") != version) | (F.col("embedding_model") != model)
    return seed_vectors.where(other).unionByName(rows)


def vector_dims(stage1: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """Widths in use among the usable vectors of a run, with counts."""
    usable = vectors.where((F.col("embedding_model") == model) & (F.col("status") == "ok"))
    sized = usable.select("review_id", F.size("embedding").cast("long").alias("dim"))
    return (
        sized.join(stage1.select("review_id"), "review_id", "left_semi")
        .groupBy("dim")
        .agg(F.count("*").alias("n"))
    )


def check_vector_dims(dims: DataFrame, expect: int) -> None:
    """No vectors at all is fine; any width but ``expect`` is not."""
    found = [row.dim for row in dims.select("dim").limit(2).collect()]
    if found and found != [expect]:
        raise ValueError(f"expected vectors of width {expect}, found {sorted(found)}")
