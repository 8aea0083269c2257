"""Bucketed tables: what a change writes, what a read leaves out, and the steps that use them."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from plumbline.operators import upsert
from plumbline.operators.embed import HashedTrigrams
from plumbline.plans import steps
from plumbline.schemas import RAW_REVIEWS
from plumbline.sources.buckets import BucketTable, buckets_of
from plumbline.streaming.ingest import stream_ingest
from test_run import MODEL, SALT, lines, new_store, write

NO = 16


def files(path):
    """Data files by bucket."""
    out: dict[str, set[str]] = {}
    for f in glob.glob(f"{path}/buckets=*/bucket=*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(f)), set()).add(os.path.basename(f))
    return out


def reviews(spark, ids, run="r1", version=""):
    df = spark.createDataFrame([(f"id{i}",) for i in ids], "review_id string")
    df = df.withColumns({"content_hash": F.concat(F.lit("h"), "review_id", F.lit(version)), "comment_text": F.lit(f"text{version}"), "pipeline_run_id": F.lit(run), "store_id": F.lit(f"s-{run}")})
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_REVIEWS.fields if f.name not in df.columns]
    return df.select("*", *missing).select(*RAW_REVIEWS.names)


@pytest.fixture
def raw(spark, folder):
    table = BucketTable(spark, f"{folder}/raw", RAW_REVIEWS, buckets=NO)
    assert table.read().collect() == []
    table.append(reviews(spark, range(1000)))
    return table


def test_a_load_rewrites_the_buckets_of_changed_reviews_only(spark, raw):
    before = files(raw.path)
    assert len(before) == NO and sum(map(len, before.values())) == NO
    edited, new = reviews(spark, (3, 5), "r2", "x"), reviews(spark, range(1000, 1003), "r2")
    batch = edited.unionByName(new).unionByName(reviews(spark, range(10, 60), "r2"))
    where = lambda df: {f"bucket={b}" for b in buckets_of(df.withColumn("bucket", raw.bucket()))}
    ops = upsert.merge_reviews(raw, batch)
    assert tuple(upsert.merge_stats(ops).first()) == (3, 2, 50, 50)
    after = files(raw.path)
    for bucket in after:
        if bucket in where(edited):
            assert not after[bucket] & before[bucket]
        elif bucket in where(new):
            assert after[bucket] > before[bucket]
        else:
            assert after[bucket] == before[bucket]
    got = {r.review_id: (r.pipeline_run_id, r.comment_text, r.store_id) for r in raw.read().collect()}
    assert len(got) == 1003 and raw.read().count() == 1003
    assert got["id3"] == ("r2", "textx", "s-r1") and got["id10"] == ("r1", "text", "s-r1") and got["id1001"] == ("r2", "text", "s-r2")
    # A repeated load, as after a failure, writes nothing.
    assert tuple(upsert.merge_stats(upsert.merge_reviews(raw, batch)).first()) == (0, 0, 55, 55) and files(raw.path) == after


def test_merge_equals_the_plain_upsert(spark, raw):
    target = spark.createDataFrame(raw.read().collect(), RAW_REVIEWS)
    batch = reviews(spark, range(0, 1200, 7), "r2", "y").unionByName(reviews(spark, range(1, 50, 7), "r2"))
    want = sorted(map(str, upsert.upsert_reviews(target, batch).collect()))
    upsert.merge_reviews(raw, batch)
    assert sorted(map(str, raw.read().collect())) == want


def test_other_buckets_are_not_read(spark, raw):
    plan = raw.stored([2, 3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in raw.stored([2, 3]).select("bucket").distinct().collect()} == {2, 3}


def test_another_number_of_buckets(spark, raw):
    other = raw.rebucket(4)
    assert sorted(map(str, other.read().collect())) == sorted(map(str, raw.read().collect()))
    assert len(glob.glob(f"{raw.path}/buckets=4/bucket=*")) == 4


def test_dropped_rows(spark, folder):
    rows = spark.createDataFrame([("a", "m", "h1", 1), ("a", "n", "h1", 2), ("b", "m", "h1", 3), (None, "m", "h", 4)], "review_id string, model string, hash string, v int")
    log = BucketTable(spark, f"{folder}/log", rows.withColumn("at", F.current_timestamp()).schema, buckets=3, written_at="at", drop_by=("model", "hash"))
    now = lambda df: df.withColumn("at", F.current_timestamp())
    left = lambda: sorted(r.v for r in log.read().collect())
    log.append(now(rows))
    log.drop(spark.createDataFrame([("a", "m"), ("b", "n"), ("zz", None)], "review_id string, model string"))
    assert left() == [2, 3, 4]
    log.append(now(rows.where("v = 1")))  # the same text again: a new row lives
    assert left() == [1, 2, 3, 4]
    log.drop(spark.createDataFrame([("b", "h2"), ("a", "h1")], "review_id string, hash string"))
    assert left() == [3, 4]
    stored = log.stored().count()
    log.compact()
    assert left() == [3, 4] and log.stored().count() < stored
    log.append(now(rows.where("review_id = 'a'")))
    assert left() == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        BucketTable(spark, folder, rows.schema).drop(rows)


def test_drops_of_many_keys_are_written_by_many_tasks(spark, folder):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("review_id"), F.timestamp_seconds(F.lit(0)).alias("at"))
    log = BucketTable(spark, f"{folder}/log", rows.schema, buckets=3, written_at="at")
    log.append(rows)
    together = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(together, "false")
    try:
        log.drop(rows.where("review_id < 'c'"))
    finally:
        spark.conf.set(together, "true")
    assert len(glob.glob(f"{folder}/log/dropped/*.parquet")) > 1
    assert log.read().count() == rows.where("review_id >= 'c'").count()


def test_layer2_writes_new_vectors_only(spark, folder):
    store = new_store(spark, folder)

    def run(name, run_id, rows):
        manifest = steps.ingest(store, write(folder, name, rows), SALT, run_id=run_id).first()
        steps.load_batch(store, f"{store.path('batches')}/{manifest.crawl_batch_id}", run_id)
        steps.run_layer1(store, run_id)
        steps.run_layer2(store, run_id, HashedTrigrams(32), MODEL, "v1", threshold=0.5, width=32)

    run("a.jsonl", "r1", lines(30))
    vectors = store.path("review_vectors")
    before, n = files(vectors), store.current("review_vectors").count()
    run("b.jsonl", "r2", lines(34, edited=(1, 2)))
    after = files(vectors)
    assert all(after[b] >= before[b] for b in before)
    stage1 = store.read_run("stage1", "r2")
    fresh = store.current("review_vectors").where("pipeline_run_id = 'r2'")
    assert {r[0] for r in fresh.select("review_id").collect()} == {r[0] for r in stage1.select("review_id").collect()}
    assert store.current("review_vectors").count() == n - 2 + stage1.count()
    current = store.current("raw_reviews").select("review_id", F.col("content_hash").alias("now"))
    assert store.current("review_vectors").join(current, "review_id").where("content_hash <> now").isEmpty()


def test_stream_drops_stale_vectors_and_keeps_rejects(spark, folder):
    store = new_store(spark, f"{folder}/s")
    inbox = f"{folder}/inbox"
    os.makedirs(inbox)
    feed = lambda: stream_ingest(store, inbox, SALT, "r", f"{folder}/ck").awaitTermination()
    write(inbox, "1.jsonl", lines(12))
    feed()
    steps.run_layer1(store, "r")
    steps.run_layer2(store, "r", HashedTrigrams(32), MODEL, "v1", threshold=0.5)
    n = store.current("review_vectors").count()
    write(inbox, "2.jsonl", [*lines(12, edited=(1, 3)), "{broken"])
    feed()
    assert store.current("review_vectors").count() == n - 2
    rejects = spark.read.parquet(store.path("stream_rejects"))
    assert rejects.count() == 1 and "value" not in rejects.columns
    before = files(store.path("raw_reviews"))
    write(inbox, "3.jsonl", lines(12, edited=(1, 3)))  # the same reviews again
    feed()
    assert files(store.path("raw_reviews")) == before and store.current("review_vectors").count() == n - 2
