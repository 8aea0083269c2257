"""Session defaults and the shared-storage checkpoint helper."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC and ANSI are part of the results; the rest lets AQE size shuffles, split
# skewed partitions and choose broadcasts from measured sizes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column makes building a plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

ARROW_BATCH_BYTES = 4 << 20


def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return pin_runtime(builder.getOrCreate())


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Set the result-relevant options and the size of Arrow batches on a session
    somebody else built, and send this package to its workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # Rows of texts and pages are long: a batch for Python is bounded by bytes long before it is by rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Workers run functions of this package, so they must be able to import it."""
    context = spark.sparkContext
    if getattr(context, "_plumbline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "plumbline")
    context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
    context._plumbline_shipped = True


def _checkpoints(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where none is set, as in local tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a new folder that all executors share."""
    return f"{_checkpoints(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's checkpoint folder.

    Used after remote scoring or embedding so that a lost executor never
    repeats paid calls, and before a table is overwritten that ``df`` reads.
    """
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
