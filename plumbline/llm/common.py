"""What the operators of this subpackage share: session set-up, shared folders, table reads and Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from plumbline.session import pin_runtime

#: Rows of one Arrow batch. Texts may be long, so a batch holds few of them.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Pin result-relevant options, ship the package to the workers and keep Arrow batches small."""
    pin_runtime(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, which all executors share.

    A temporary folder is used only where none is set on a local master, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return f"{context.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of an Arrow column; null is empty."""
    return pc.fill_null(column, "").to_pylist()


def give_back() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only this C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and at the end of each task what it has freed goes back to the system, not to the reused worker."""

    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return tidied


def slices(array: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array that hold about ``most`` bytes each; a longer row stands alone."""
    lengths = pc.binary_length(array).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        if total and total + (n or 0) > most:
            yield begin, i
            begin, total = i, 0
        total += n or 0
    if begin < len(lengths):
        yield begin, len(lengths)
