"""The registered queries and the SQL twins."""

from __future__ import annotations

import pytest

import corpus_pipeline
from check_oracle import compare, connect
from plumbline.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twins(spark, name):
    assert compare(spark, connect(FOLDER), name, QUERIES[name], ORACLE_SQL[name], FOLDER) is None
