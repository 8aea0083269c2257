"""Stored tables: run-scoped rebuilds, staging, snapshots, the run ledger, pre-checks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN = "pipeline_run_id"


def _partition_value(value: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", value):
        raise ValueError(f"not usable as a partition value: {value!r}")
    return value


def write_slice(df: DataFrame, path: str, **keys: str) -> None:
    """Replace one partition of a table, also when ``df`` is empty.

    Dynamic partition overwrite would leave the old rows of a run that now has
    none, so the partition folder itself is the overwrite target.
    """
    folder = "/".join(f"{name}={_partition_value(value)}" for name, value in keys.items())
    df.drop(*keys).write.mode("overwrite").parquet(f"{path}/{folder}")


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    write_slice(df, path, **{RUN: run_id})


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", path).parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str, schema: StructType | None = None) -> DataFrame:
    """One run of a table; the filter prunes to that run's partition folder."""
    return read_table(spark, path, schema).where(F.col(RUN) == run_id)


def stage_batch(batch: DataFrame, path: str) -> DataFrame:
    """Bulk-load a batch to a columnar staging table and read it back."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.parquet(path)


def _versions(spark: SparkSession, pattern: str) -> dict[str, list[int]]:
    """Folders that hold complete versions, with their version numbers. Readers go
    by the success marker, so they never see a half-written state."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/version=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    folders: dict[str, list[int]] = {}
    for status in found:
        version = status.getPath().getParent()
        folders.setdefault(version.getParent().toString(), []).append(int(version.getName().split("=")[1]))
    return folders


def write_version(df: DataFrame, path: str, **keys: str) -> int:
    """Write the next full state of a table (or of one slice of it) beside the
    earlier ones. ``df`` may read the state it replaces."""
    folder = "/".join([path, *[f"{name}={_partition_value(value)}" for name, value in keys.items()]])
    version = max(sum(_versions(df.sparkSession, folder).values(), [0])) + 1
    df.drop(*keys).write.mode("overwrite").parquet(f"{folder}/version={version:012d}")
    return version


def read_latest(spark: SparkSession, path: str, schema: StructType, slices: str = "") -> DataFrame:
    """Newest complete state of a table. For a sliced table, ``slices`` is the
    folder pattern of its slices, such as ``pipeline_run_id=*``."""
    folders = _versions(spark, f"{path}/{slices}" if slices else path)
    newest = [f"{folder}/version={max(versions):012d}" for folder, versions in folders.items()]
    if not newest:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*newest)
    return rows.select(*schema.names)


def replace_slices(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the slices, by ``keys``, that ``df`` has rows for; files of other slices stay as they are."""
    rows = df.repartition(*keys).write.partitionBy(*keys)
    rows.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def require_tables(spark: SparkSession, names: list[str]) -> None:
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise LookupError(f"tables missing: {', '.join(missing)}")


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise LookupError(f"columns missing: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Phase gate: stop with ``message`` when ``df`` has no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def assert_single_batch(df: DataFrame) -> str:
    """The one batch id of a file; none or several is an error."""
    ids = [row[0] for row in df.select("crawl_batch_id").distinct().limit(2).collect()]
    if len(ids) != 1:
        raise ValueError("no rows to load" if not ids else "more than one crawl_batch_id; load one batch at a time")
    return ids[0]


# -- run ledger --------------------------------------------------------------


def append_run_event(events_path: str, event: DataFrame) -> None:
    """The ledger only grows; the state of a run is its newest event."""
    event.write.mode("append").parquet(events_path)


def run_states(events: DataFrame) -> DataFrame:
    """Newest event per run. Fields that an event leaves NULL keep their earlier value."""
    sticky = [c for c in events.columns if c not in (RUN, "phase", "status", "started_at")]
    replaced = ["phase", "status", "finished_at", "rows_in", "rows_out", "error_message"]
    kept = [c for c in sticky if c not in replaced and c != "heartbeat_at"]
    # Events of one moment: the later status wins, then the later phase by name.
    done = F.col("status").isin("succeeded", "failed")
    newest = F.struct("heartbeat_at", done, "status", "phase", F.coalesce("error_message", F.lit("")))
    return events.groupBy(RUN).agg(
        *[F.max_by(c, newest).alias(c) for c in replaced],
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), newest)).alias(c)
            for c in kept
        ],
        F.max("heartbeat_at").alias("heartbeat_at"),
        F.min("started_at").alias("started_at"),
    )


def latest_run(runs: DataFrame, phase: str) -> DataFrame:
    """One row, one column: the run of ``phase`` that finished last with success."""
    done = (F.col("phase") == phase) & (F.col("status") == "succeeded")
    newest = F.max_by(RUN, F.struct("finished_at", RUN))
    return runs.where(done).agg(newest.alias(RUN))


def latest_run_view(df: DataFrame, runs: DataFrame, phase: str) -> DataFrame:
    """Rows of the latest succeeded run; the scalar subquery prunes partitions at run time."""
    return df.where(F.col(RUN) == latest_run(runs, phase).scalar())


# -- versioned dimensions ----------------------------------------------------


def reload_version(dimension: DataFrame, rows: DataFrame, version: str, column: str) -> DataFrame:
    """Dimension with one version replaced."""
    kept = dimension.where(F.col(column) != version)
    return kept.unionByName(rows.withColumn(column, F.lit(version)))
