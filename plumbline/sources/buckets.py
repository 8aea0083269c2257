"""Keyed tables in hash buckets, so that a change touches the buckets of its keys and no others.

A row lies in the partition folder of its key's bucket. Three kinds of change exist: rows are appended, whole buckets
are replaced (Spark's dynamic partition overwrite: folders of buckets that the new rows do not have stay as they are),
or rows are marked as dropped by small rows beside the table; reads leave these rows out and ``compact`` removes them.
Appending and dropping never rewrite a row.

The number of buckets is part of the folder and belongs to the table; ``rebucket`` deals the rows into another number.
A bucket's rows are written in as many files as their size asks for, so a table may have far fewer buckets than tasks.
One writer at a time is assumed, as for the run folders; readers and a failed write do not disturb each other, since
replaced folders change when the write has succeeded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

BUCKET = "bucket"
DROPPED_AT = "dropped_at"


@dataclass(frozen=True)
class BucketTable:
    """Rows of ``schema`` below ``path``. ``written_at`` names the column that tells when a row came in; only tables
    with one can have rows dropped, and ``drop_by`` says which columns beside the key a drop may name."""

    spark: SparkSession
    path: str
    schema: StructType
    key: str = "review_id"
    buckets: int = 64
    written_at: str | None = None
    drop_by: tuple[str, ...] = ()

    # -- reading -----------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, folder: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    @property
    def _folder(self) -> str:
        return f"buckets={self.buckets}"

    def stored(self, only: list[int] | None = None) -> DataFrame:
        """All rows as written, or those of some buckets, with their ``bucket``; the folders of others are pruned."""
        rows = self._read(self._folder, StructType([*self.schema.fields, StructField(BUCKET, IntegerType())]))
        return rows if only is None else rows.where(F.col(BUCKET).isin(only))

    def drops(self) -> DataFrame:
        kinds = [self.schema[c] for c in (self.key, *self.drop_by)]
        return self._read("dropped", StructType([*kinds, StructField(DROPPED_AT, TimestampType())]))

    def read(self, only: list[int] | None = None) -> DataFrame:
        """Rows of the table that are not dropped."""
        return self._live(self.stored(only)).select(*self.schema.names)

    def _live(self, rows: DataFrame) -> DataFrame:
        if self.written_at is None:
            return rows
        gone, kept = self.drops().alias("d"), rows.alias("r")
        hit = (F.col(f"r.{self.key}") == F.col(f"d.{self.key}")) & (F.col(f"r.{self.written_at}") <= F.col(f"d.{DROPPED_AT}"))
        for name in self.drop_by:
            hit &= F.col(f"d.{name}").isNull() | (F.col(f"r.{name}") == F.col(f"d.{name}"))
        return kept.join(gone, hit, "left_anti")

    # -- changing ----------------------------------------------------------------

    def _write(self, rows: DataFrame, mode: str) -> None:
        dealt = rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        writer = dealt.write.mode(mode).partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic")
        writer.parquet(f"{self.path}/{self._folder}")

    def append(self, rows: DataFrame) -> None:
        self._write(rows, "append")

    def replace_buckets(self, rows: DataFrame) -> None:
        """``rows`` become the content of their buckets. They may be computed from what they replace."""
        self._write(rows, "overwrite")

    def drop(self, keys: DataFrame) -> None:
        """Leave out rows written so far that have one of ``keys``; a missing or null ``drop_by`` column means any."""
        if self.written_at is None:
            raise ValueError("rows of this table carry no time and cannot be dropped")
        others = [F.col(c) if c in keys.columns else F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.drop_by]
        now = F.current_timestamp().alias(DROPPED_AT)
        # A shuffle of the marks alone makes few files of them; ``coalesce`` would put the work that finds them into one task.
        marks = keys.select(self.key, *others).distinct().select("*", now).hint("rebalance")
        marks.write.mode("append").parquet(f"{self.path}/dropped")

    def compact(self, only: list[int] | None = None) -> None:
        """Write all buckets, or some, anew without dropped rows and in few files. Drops stay listed: they match nothing
        that comes later, and a bucket of dropped rows alone keeps its files."""
        self.replace_buckets(self._live(self.stored(only)))

    def rebucket(self, buckets: int) -> BucketTable:
        """The same rows in another number of buckets; the old folder stays until its owner removes it."""
        other = BucketTable(self.spark, self.path, self.schema, self.key, buckets, self.written_at, self.drop_by)
        other.replace_buckets(self.stored())
        return other


def buckets_of(rows: DataFrame) -> list[int]:
    """Distinct ``bucket`` numbers of ``rows``, at most as many as the table has."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
