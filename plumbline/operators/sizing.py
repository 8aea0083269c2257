"""Joins of a large table with a change set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its values really are small, else as it is,
    which leaves an ordinary shuffled join. Plan statistics cannot tell, as
    checkpoints and aggregates have none, so the values are measured."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("n")).first()["n"]
    return F.broadcast(df) if (size or 0) <= max_bytes else df


def matching(large: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``large`` that have one of ``keys``. With few keys the large table
    is streamed past them and never shuffled."""
    return large.join(small_side(keys.select(*names).distinct()), names, "left_semi")


def without(large: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``large`` that have none of ``keys``."""
    return large.join(small_side(keys.select(*names).distinct()), names, "left_anti")
