"""The whole run on a small project, twice, plus rewrites and reuse across runs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.constants import SEED_CATEGORIES
from plumbline.operators import upsert
from scorers import RuleScorer
from plumbline.operators.embed import HashedTrigrams
from plumbline.plans import steps
from plumbline.plans.store import ReviewStore
from plumbline.sources.reviews import delivery_phrases
from plumbline.streaming.ingest import stream_ingest

SALT = "0123456789abcdef"
MODEL = "trigrams"
SEED_TEXTS = {c: f"best {c.replace('_', ' ')} ever, I recommend and repurchase" for c in SEED_CATEGORIES}


def lines(n=60, edited=()):
    out = []
    for i in range(n):
        text = f"best personal trial ever, I recommend and repurchase number {i % 3}" if i % 2 else f"the lid of pot {i} was scratched and it took nine days"
        if i % 10 == 4:
            text = "fast delivery"
        if i in edited:
            text += " (edited)"
        out.append(
            {
                "native_review_id": f"n{i}", "store_id": f"s{i % 4}", "product_id": "p", "reviewer_id_raw": f"u{i}", "star_rating": 5 if i % 7 else 3,
                "comment_text": text, "review_ts": f"2024-01-{i % 28 + 1:02d}T{i % 24:02d}:00:00Z",
            }
        )
    return out


def write(folder, name, rows):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return path


def new_store(spark, folder):
    store = ReviewStore(spark, f"{folder}/store")
    store.replace("phrases", delivery_phrases(spark))
    rows = spark.createDataFrame([(f"seed{i}", c, t) for i, (c, t) in enumerate(SEED_TEXTS.items())], "seed_id string, category string, seed_text string")
    store.replace("seeds", upsert.upsert_seeds(store.current("seeds"), rows, "v1"))
    return store


def whole_run(store, path, run_id, **audit):
    manifest = steps.ingest(store, path, SALT, run_id=run_id).first()
    steps.load_batch(store, f"{store.path('batches')}/{manifest.crawl_batch_id}", run_id)
    steps.run_layer1(store, run_id)
    steps.run_layer2(store, run_id, HashedTrigrams(256), MODEL, "v1", threshold=0.5, width=256)
    counters = steps.run_audit(store, run_id, RuleScorer(), "x-3.5-flash", "p1", ["stock-best"], **audit).first()
    summary = steps.run_analyze(store, run_id, MODEL, list_pairs=True).first()
    return manifest, counters, summary


def state(store, run_id):
    plain = lambda df: sorted(map(str, df.drop("computed_at", "embedded_at", "assessed_at").collect()))
    tables = ("l1_audit", "stage1", "l2_audit", "stage2", "store_stats", "bursts", "pair_counts", "edges", "funnel")
    return {t: plain(store.read_run(t, run_id)) for t in tables}


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("project"))
    store = new_store(spark, folder)
    path = write(folder, "a.jsonl", [*lines(), "{broken"])
    first = whole_run(store, path, "run1")
    return folder, store, path, first


def test_first_run(project):
    _, store, _, (manifest, counters, summary) = project
    assert (manifest.n_read, manifest.n_rejected, manifest.n_accepted, manifest.n_written, manifest.n_deduped) == (61, 1, 60, 60, 0)
    assert summary.n_raw == 60 and 0 < summary.n_stage2 <= summary.n_stage1 < 60
    assert counters.n_scored == summary.n_stage2 == summary.n_assessed and counters.n_errors == 0
    assert counters.cost_usd_est > 0 and counters.n_copied == 0
    pairs = store.read_run("collision_pairs", "run1")
    assert pairs.count() == summary.n_collisions > 0
    edges = store.read_run("edges", "run1").collect()
    assert sum(e.weight for e in edges) == summary.n_collisions and all(e.src_store_id < e.dst_store_id for e in edges)
    assert {e.weight for e in edges if e.template_ids == ["stock-best"]}
    phases = {r.phase: r.status for r in store.spark.read.parquet(store.path("run_events")).where("status <> 'running'").collect()}
    assert phases == {p: "succeeded" for p in ("load", "layer1", "layer2", "audit", "analyze")}


def test_steps_can_be_repeated(project):
    _, store, _, _ = project
    before = state(store, "run1")
    steps.run_layer1(store, "run1")
    steps.run_layer2(store, "run1", HashedTrigrams(256), MODEL, "v1", threshold=0.5)
    counters = steps.run_audit(store, "run1", RuleScorer(), "x-3.5-flash", "p1", ["stock-best"]).first()
    steps.run_analyze(store, "run1", MODEL)
    assert state(store, "run1") == before
    assert counters.n_attempted == 0 and counters.n_pending == 0
    assert store.current("review_vectors").count() == store.read_run("stage1", "run1").count()


def test_report(project, spark):
    folder, store, _, _ = project
    report = steps.load_report(store, "run1")
    assert report["funnel"].first().n_raw == 60
    assert sum(r.n for r in report["layer1"].collect()) == 60
    assert sum(r.n for r in report["layer2"].collect()) == store.read_run("stage1", "run1").count()
    steps.export_report(store, "run1", f"{folder}/report")
    summary = json.loads(spark.read.text(f"{folder}/report/json/summary").first().value)
    assert summary["funnel"]["n_raw"] == 60 and len(summary["layer3"]) == 4
    assert spark.read.text(f"{folder}/report/edges.dot").first().value == "graph {"
    with pytest.raises(Exception):
        steps.load_report(store, "no-such-run")


def test_calibration_needs_labels(project, spark):
    _, store, _, _ = project
    with pytest.raises(ValueError, match="no labels"):
        steps.run_calibrate(store, "run1")
    some = store.read_run("stage1", "run1").select("review_id").limit(6)
    rows = some.select("review_id", F.lit("shill").alias("label"), F.lit(None).cast("string").alias("stratum"), F.lit(None).cast("string").alias("notes"))
    store.replace("labels", upsert.upsert_labels(store.current("labels"), rows, "run1"))
    sweep = steps.run_calibrate(store, "run1", usd_per_row=0.0036, grid=[0.3, 0.5]).collect()
    assert [r.metric_kind for r in sweep] == ["layer2_distance"] * 2 + ["layer3_score"] and {r.n_labeled for r in sweep} == {6}


def test_second_run_takes_only_what_changed(project):
    """A reload moves rewritten reviews to the new run and leaves the rest alone."""
    folder, store, _, _ = project
    path = write(folder, "b.jsonl", lines(62, edited=(1, 3)))
    vectors = store.current("review_vectors").count()
    manifest = steps.ingest(store, path, SALT, run_id="run2").first()
    stats = steps.load_batch(store, f"{store.path('batches')}/{manifest.crawl_batch_id}", "run2").first()
    assert (stats.n_inserted, stats.n_updated, stats.n_unchanged) == (2, 2, 58)
    raw = store.current("raw_reviews")
    assert raw.count() == 62 and {r[0]: r[1] for r in raw.groupBy("pipeline_run_id").count().collect()} == {"run1": 58, "run2": 4}
    assert store.current("review_vectors").count() == vectors - 2
    steps.run_analyze(store, "run1", MODEL)
    assert store.read_run("funnel", "run1").first().n_raw == 58


def test_scores_are_copied_forward(spark, folder):
    store = new_store(spark, folder)
    path = write(folder, "a.jsonl", lines(20))
    whole_run(store, path, "run1", attempts=2, partitions=2)
    stage2 = store.read_run("stage2", "run1").withColumn("pipeline_run_id", F.lit("run2"))
    store.write_run("stage2", stage2, "run2")
    counters = steps.run_audit(store, "run2", RuleScorer(), "x-3.5-flash", "p1", ["stock-best"]).first()
    assert counters.n_copied == stage2.count() > 0 and counters.n_attempted == 0
    store.write_run("stage2", stage2, "run3")
    other = steps.run_audit(store, "run3", RuleScorer(), "other", "p1", ["stock-best"], limit=1).first()
    assert (other.n_copied, other.n_copy_skipped_model_mismatch, other.n_attempted, other.cost_usd_est) == (0, stage2.count(), 1, None)


def test_failed_step_is_recorded(spark, folder):
    store = new_store(spark, folder)
    with pytest.raises(Exception):
        steps.run_layer2(store, "r", HashedTrigrams(), MODEL, "v1")
    assert store.runs().first().status == "failed"


def test_stream_equals_batch(spark, folder):
    batch = new_store(spark, f"{folder}/1")
    manifest = steps.ingest(batch, write(folder, "all.jsonl", lines(30, edited=(1,))), SALT, run_id="r").first()
    steps.load_batch(batch, f"{batch.path('batches')}/{manifest.crawl_batch_id}", "r")

    import os

    inbox = f"{folder}/inbox"
    os.makedirs(inbox)
    stream = new_store(spark, f"{folder}/2")
    write(inbox, "1.jsonl", lines(20))
    stream_ingest(stream, inbox, SALT, "r", f"{folder}/ck").awaitTermination()
    write(inbox, "2.jsonl", [*lines(30, edited=(1,)), "{broken"])
    for _ in range(2):
        stream_ingest(stream, inbox, SALT, "r", f"{folder}/ck").awaitTermination()
    columns = ["review_id", "content_hash", "store_id", "star_rating", "review_ts"]
    rows = lambda store: sorted(map(tuple, store.current("raw_reviews").select(*columns).collect()))
    assert rows(stream) == rows(batch) and len(rows(batch)) == 30


def test_seed_vectors_are_replaced_by_slice(spark, folder):
    import glob

    store = ReviewStore(spark, folder)
    assert store.current("seed_vectors").collect() == []

    def vectors(version, model, *ids):
        rows = [(version, i, "c", [1.0, 2.0], model) for i in ids]
        made = spark.createDataFrame(rows, "seed_version string, seed_id string, category string, embedding array<double>, embedding_model string")
        return made.withColumn("embedded_at", F.current_timestamp())

    def put(version, model, *ids):
        store.replace_slice("seed_vectors", vectors(version, model, *ids), seed_version=version, embedding_model=model)

    have = lambda: sorted((r.seed_version, r.embedding_model, r.seed_id) for r in store.current("seed_vectors").collect())
    put("1", "org/model:1", "a", "b")
    put("2", "org/model:1", "a")
    before = set(glob.glob(f"{folder}/seed_vectors/seed_version=2/**/*.parquet", recursive=True))
    put("1", "org/model:1", "c")
    put("1", "other", "d")
    assert have() == [("1", "org/model:1", "c"), ("1", "other", "d"), ("2", "org/model:1", "a")]
    assert before and before == set(glob.glob(f"{folder}/seed_vectors/seed_version=2/**/*.parquet", recursive=True))
    put("1", "org/model:1")
    assert have() == [("1", "other", "d"), ("2", "org/model:1", "a")]
