from __future__ import annotations

import datetime as dt
import random

import pytest

from plumbline.operators import bursts
from plumbline.streaming import bursts as streamed

SCHEMA = "review_id string, store_id string, product_id string, star_rating long, review_ts timestamp"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def reviews(first, last, n, seed):
    random.seed(seed)
    begin = dt.datetime(2024, 3, 1)
    out = []
    for i in range(n):
        store = "hot" if i % 3 else f"s{random.randrange(4)}"
        at = begin + dt.timedelta(seconds=random.randrange(first * 86400, last * 86400))
        out.append((f"{seed}-{i}", store, random.choice(["p", "q", None]), random.choice([5, 5, 5, 3]), at))
    return out


def send(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{name}")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/*")
    streamed.stream_hour_counts(stream, f"{folder}/hours", f"{folder}/ck").awaitTermination(120)


def test_stream_with_late_rows_equals_batch(spark, folder):
    first, late, rush = reviews(0, 6, 400, 1), reviews(4, 7, 200, 2), [(f"r{i}", "hot", "p", 5, dt.datetime(2024, 3, 6, 9, i)) for i in range(40)]
    far = [("far", "s0", "p", 5, dt.datetime(2024, 4, 20))]
    send(spark, folder, "1", [*first, *first[:50], ("none", "hot", "p", 5, None)])  # rows sent twice
    send(spark, folder, "2", [*late, *rush, *first[-20:]])  # late, and sent again in another batch
    send(spark, folder, "3", far)
    send(spark, folder, "4", [("too late", "hot", "p", 5, dt.datetime(2024, 3, 2)), ("end", "s0", "p", 5, dt.datetime(2024, 6, 1))])
    hours = spark.read.schema(streamed.COUNTS).parquet(f"{folder}/hours")
    # Reviews that came again were counted with their first copy, which the state still held.
    kept = spark.createDataFrame([*first, *late, *rush, *far], SCHEMA)
    names = ["store_id", "product_id", "level", "granularity", "bucket_ts", "n_reviews", "n_five_star"]
    rows = lambda df: sorted(map(str, df.select(*names).collect()))
    assert rows(streamed.with_days(hours)) == rows(bursts.bucket_counts(kept))
    flags = lambda df: sorted(str(r) for r in df.select("store_id", "product_id", "bucket_ts", "granularity", "n_reviews", "is_burst").collect())
    assert flags(streamed.stored_bursts(hours)) == flags(bursts.burst_events(kept))
    assert any("is_burst=True" in r for r in flags(streamed.stored_bursts(hours)))


def test_nothing_sent(spark, folder):
    send(spark, folder, "1", [])
    empty = spark.createDataFrame([], streamed.COUNTS)
    assert streamed.stored_bursts(empty).collect() == []
