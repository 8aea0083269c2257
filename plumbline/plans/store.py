"""Where a project keeps its tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline import schemas
from plumbline.sources import tables
from plumbline.sources.buckets import BucketTable

# Large tables, in buckets of their review ids: changed bucket by bucket, or by appended rows.
BUCKETED = {
    "raw_reviews": dict(schema=schemas.RAW_REVIEWS),
    "review_vectors": dict(schema=schemas.REVIEW_VECTORS, written_at="embedded_at", drop_by=("embedding_model", "content_hash")),
}
# Small tables with one current state, replaced as a whole.
KEYED = {
    "phrases": schemas.PHRASES,
    "seeds": schemas.SEEDS,
    "labels": schemas.LABELS,
}
# Tables in slices: a version of the seeds has its vectors by each model, made and replaced together.
SLICED = {
    "seed_vectors": (schemas.SEED_VECTORS, ["seed_version", "embedding_model"]),
}
# Tables whose keys start with the run: each run has its own current state.
KEYED_PER_RUN = {
    "assessments": schemas.ASSESSMENTS,
    "assessment_errors": schemas.ASSESSMENT_ERRORS,
}


@dataclass
class ReviewStore:
    """Tables below one root folder on shared storage. Everything else written by
    a run (stages, audits, statistics) is one partition per run, rebuilt as a whole.
    ``buckets`` belongs to the project: it is the same in every session."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def bucketed(self, table: str) -> BucketTable:
        return BucketTable(self.spark, self.path(table), buckets=self.buckets, **BUCKETED[table])

    def current(self, table: str) -> DataFrame:
        if table in BUCKETED:
            return self.bucketed(table).read()
        if table in KEYED:
            return tables.read_latest(self.spark, self.path(table), KEYED[table])
        if table in SLICED:
            schema, _ = SLICED[table]
            try:
                rows = tables.read_table(self.spark, self.path(table), schema)
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                return self.spark.createDataFrame([], schema)
            return rows.select(*schema.names).where("seed_id IS NOT NULL")
        return tables.read_latest(self.spark, self.path(table), KEYED_PER_RUN[table], "pipeline_run_id=*")

    def replace(self, table: str, df: DataFrame, run_id: str | None = None) -> None:
        if table in KEYED:
            tables.write_version(df.select(*KEYED[table].names), self.path(table))
        else:
            mine = df.select(*KEYED_PER_RUN[table].names)
            tables.write_version(mine, self.path(table), pipeline_run_id=run_id)

    def replace_slice(self, table: str, df: DataFrame, **keys: str) -> None:
        """Replace the slice of ``keys`` by ``df``, also by nothing: a row without id stands for the slice itself."""
        schema, names = SLICED[table]
        mark = self.spark.createDataFrame([tuple(keys.get(c) for c in schema.names)], schema)
        mine = df.select(*schema.names).where(reduce(and_, [F.col(name) == keys[name] for name in names]))
        tables.replace_slices(mine.unionByName(mark), self.path(table), names)

    def write_run(self, table: str, df: DataFrame, run_id: str) -> None:
        tables.write_run(df, self.path(table), run_id)

    def read_run(self, table: str, run_id: str, schema: StructType | None = None) -> DataFrame:
        return tables.read_run(self.spark, self.path(table), run_id, schema)

    def runs(self) -> DataFrame:
        return tables.run_states(self.spark.read.schema(schemas.RUN_EVENTS).parquet(self.path("run_events")))

    def record(self, run_id: str, phase: str, status: str, **fields) -> None:
        """Append one event to the run ledger."""
        now = self.spark.sql("SELECT current_timestamp()").first()[0]
        fields = {"heartbeat_at": now, "started_at": now, **fields}
        if status != "running":
            fields.setdefault("finished_at", now)
        row = {"pipeline_run_id": run_id, "phase": phase, "status": status, **fields}
        event = self.spark.createDataFrame(
            [tuple(row.get(c) for c in schemas.RUN_EVENTS.names)], schemas.RUN_EVENTS
        )
        tables.append_run_event(self.path("run_events"), event)
