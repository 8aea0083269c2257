"""The run, step by step: ingest, load, rule filter, distances, scoring, analysis,
calibration, report. Each step is a declarative plan over stored tables and
rebuilds its run's output, so repeating it gives the same state."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.operators import assess, bursts, calibrate, collisions, embed, histograms, layer1, layer2, stores, upsert
from plumbline.plans.store import ReviewStore
from plumbline.session import durable
from plumbline.sources import exports, reviews, tables
from plumbline.sources.buckets import BUCKET, buckets_of


@contextmanager
def _phase(store: ReviewStore, run_id: str, phase: str, **fields):
    """Ledger entries around a step; a failure is recorded and raised."""
    store.record(run_id, phase, "running", **fields)
    counts: dict = {}
    try:
        yield counts
    except Exception as problem:
        store.record(run_id, phase, "failed", error_message=str(problem), **fields)
        raise
    store.record(run_id, phase, "succeeded", **fields, **counts)


def ingest(
    store: ReviewStore,
    path: str,
    salt: str,
    run_id: str | None = None,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
    strict: bool = False,
    max_reviews: int | None = None,
    **scope,
) -> DataFrame:
    """Read review JSONL, normalise it and write one batch as NDJSON. Returns the
    manifest row. All counts are observed during the one write."""
    spark = store.spark
    run_id, batch_id = run_id or str(uuid.uuid4()), batch_id or str(uuid.uuid4())
    started = spark.sql("SELECT current_timestamp()").first()[0]
    read, kept = Observation(), Observation()
    parsed = reviews.read_reviews(spark, path).observe(
        read,
        F.count("*").alias("n_read"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("n_rejected"),
    )
    good, _ = reviews.split_rejects(parsed)
    wanted = reviews.filter_reviews(good, **scope)
    if max_reviews is not None:
        wanted = reviews.cap_rows(wanted, max_reviews)
    rows = reviews.normalize_reviews(wanted, salt, batch_id, run_id, ingested_at or started).observe(
        kept, F.count("*").alias("n_accepted")
    )
    unique = upsert.last_write_wins(rows, "review_id", reviews.FILE_ORDER)
    out = f"{store.path('batches')}/{batch_id}"
    reviews.write_ndjson(unique, out)
    n_written = spark.read.text(out).count()
    n_read, n_rejected = read.get["n_read"], read.get["n_rejected"]
    if strict and n_rejected:
        raise ValueError(f"strict mode: {n_rejected} of {n_read} rows were rejected")
    return batch_manifest(
        store, path, batch_id, run_id, n_read, kept.get["n_accepted"], n_rejected, n_written, started
    )


def batch_manifest(store, path, batch_id, run_id, n_read, n_accepted, n_rejected, n_written, started) -> DataFrame:
    row = store.spark.createDataFrame(
        [(path, batch_id, run_id, n_read, n_accepted, n_rejected, n_written, n_accepted - n_written, started)],
        "input string, crawl_batch_id string, pipeline_run_id string, n_read long, n_accepted long, "
        "n_rejected long, n_written long, n_deduped long, started_at timestamp",
    ).withColumn("finished_at", F.current_timestamp())
    row.write.mode("overwrite").json(f"{store.path('manifests')}/{batch_id}")
    return row


def load_batch(store: ReviewStore, ndjson: str, run_id: str) -> DataFrame:
    """Upsert one batch into the raw table: latest row per id, preview, drop the
    vectors of changed reviews, merge. Returns the merge counts."""
    with _phase(store, run_id, "load") as counts:
        ordered = reviews.read_normalized(store.spark, ndjson)
        unique = upsert.last_write_wins(ordered, "review_id", reviews.FILE_ORDER).drop(*reviews.FILE_ORDER)
        latest = upsert.latest_per_key(unique.withColumn("pipeline_run_id", F.lit(run_id)), "review_id", ["updated_at"])
        # The batch is worked out once; everything below reads it from its files.
        batch = tables.stage_batch(latest, f"{store.path('staging')}/{uuid.uuid4()}")
        tables.assert_single_batch(batch)
        stats = merge_batch(store, batch)
        row = stats.first()
        counts.update(rows_in=row.n_inserted + row.n_updated + row.n_unchanged, rows_out=row.n_inserted + row.n_updated)
        return stats


def merge_batch(store: ReviewStore, batch: DataFrame) -> DataFrame:
    """Merge stored rows, one per id, into the raw table and drop the vectors of reviews that change."""
    raw, vectors = store.bucketed("raw_reviews"), store.bucketed("review_vectors")
    known = raw.stored(buckets_of(batch.withColumn(BUCKET, raw.bucket())))
    changed = upsert.changed_ids(batch, known)
    # Before the merge: a load cut off between the two has dropped vectors that are made again, and no stale one is left.
    if not changed.isEmpty():
        vectors.drop(changed)
    return upsert.merge_stats(durable(upsert.merge_reviews(raw, batch)))


def run_layer1(store: ReviewStore, run_id: str, min_chars: int = C.MIN_TEXT_CHARS) -> DataFrame:
    with _phase(store, run_id, "layer1") as counts:
        raw = stores.of_run(store.current("raw_reviews"), run_id)
        phrases = store.current("phrases")
        store.write_run("l1_audit", layer1.l1_audit(raw, phrases, min_chars=min_chars), run_id)
        # Phrases are looked for once: what passed is read from the audit.
        stage1 = layer1.passed(raw, store.read_run("l1_audit", run_id))
        store.write_run("stage1", stage1, run_id)
        summary = layer1.l1_funnel(store.read_run("l1_audit", run_id), store.read_run("stage1", run_id))
        row = summary.first()
        counts.update(rows_in=row.n_in, rows_out=row.n_out)
        return summary


def run_layer2(
    store: ReviewStore,
    run_id: str,
    embedder: embed.Embedder,
    model: str,
    seed_version: str,
    threshold: float = C.SEED_DISTANCE_THRESHOLD,
    width: int | None = None,
    char_cap: int | None = None,
) -> DataFrame:
    """Fill missing vectors, measure distances, keep stage 2."""
    fields = {"seed_version": seed_version, "embedding_model": model, "cosine_distance_threshold": float(threshold)}
    with _phase(store, run_id, "layer2", **fields) as counts:
        stage1 = store.read_run("stage1", run_id)
        seeds = store.current("seeds")
        made = embed.embed_seeds(seeds, embedder, model, seed_version)
        store.replace_slice("seed_vectors", made, seed_version=seed_version, embedding_model=model)
        log = store.bucketed("review_vectors")
        stale = embed.stale_vectors(log.read(), stage1, model)
        if not stale.isEmpty():
            log.drop(stale)
        # Only new vectors are written; earlier ones are neither read again nor moved.
        log.append(embed.embed_missing(stage1, log.read(), embedder, model, run_id, char_cap))

        vectors = store.current("review_vectors")
        active = layer2.active_seeds(store.current("seed_vectors"), seeds, seed_version, model)
        layer2.layer2_gates(active, stage1, vectors, model)
        if width is not None:
            embed.check_vector_dims(embed.vector_dims(stage1, vectors, model), width)
        audit = layer2.distance_audit(stage1, vectors, active, run_id, model, threshold)
        store.write_run("l2_audit", audit.drop("comment_text"), run_id)
        near = layer2.l2_filter(store.read_run("l2_audit", run_id), threshold)
        store.write_run("stage2", near.join(stage1.select("review_id", "comment_text"), "review_id"), run_id)
        summary = layer2.l2_funnel(stage1, vectors, store.read_run("stage2", run_id), model)
        row = summary.first()
        counts.update(rows_in=row.n_stage1, rows_out=row.n_suspicious)
        return summary


def run_audit(
    store: ReviewStore,
    run_id: str,
    scorer: assess.Scorer,
    model: str,
    prompt: str,
    allowed_templates: list[str],
    skip_existing: bool = True,
    force: bool = False,
    limit: int | None = None,
    max_rows: int | None = None,
    attempts: int = assess.MAX_ATTEMPTS,
    partitions: int | None = None,
) -> DataFrame:
    """Copy earlier scores forward, score the rest, store results and failures. A
    call is tried ``attempts`` times; ``partitions`` bounds the calls in flight."""
    with _phase(store, run_id, "audit", scorer_model=model) as counts:
        stage2, raw = store.read_run("stage2", run_id), store.current("raw_reviews")
        n_copied = n_skipped = 0
        if skip_existing and not force:
            known = store.current("assessments")
            new = durable(
                upsert.append_copied(known, assess.copy_forward_candidates(stage2, raw, known, run_id, model, prompt))
            )
            n_copied = upsert.copied_count(new).first().n_copied
            n_skipped = assess.count_copy_skips(stage2, raw, known, run_id, model, prompt).first().n
            if n_copied:
                store.replace("assessments", stores.of_run(known, run_id).unionByName(new), run_id)
        scored, errors = store.current("assessments"), store.current("assessment_errors")
        pending = durable(assess.select_pending(stage2, raw, scored, errors, run_id, force))
        rows, failures, counters = assess.score_pending(
            pending, scorer, run_id, model, prompt, allowed_templates, limit, max_rows, attempts=attempts, partitions=partitions
        )
        kept, open_errors = upsert.upsert_assessments(
            stores.of_run(scored, run_id), rows, stores.of_run(errors, run_id)
        )
        result = durable(counters.withColumn("n_copied", F.lit(n_copied)).withColumn(
            "n_copy_skipped_model_mismatch", F.lit(n_skipped)
        ).withColumn("n_pending", F.lit(pending.count())))
        store.replace("assessments", kept, run_id)
        store.replace("assessment_errors", upsert.append_errors(open_errors, failures), run_id)
        row = result.first()
        counts.update(rows_in=row.n_attempted, rows_out=row.n_scored)
        return result


def run_analyze(
    store: ReviewStore,
    run_id: str,
    model: str,
    min_score: int = C.SCORE_THRESHOLD,
    pair_distance: float = C.STORE_PAIR_DISTANCE_THRESHOLD,
    list_pairs: bool = False,
) -> DataFrame:
    """Store rates, bursts, collisions, edges and funnel of a run. Collisions are
    stored per store pair and template; ``list_pairs`` also writes every review pair."""
    with _phase(store, run_id, "analyze") as counts:
        raw, assessments = store.current("raw_reviews"), store.current("assessments")
        stage1, stage2 = store.read_run("stage1", run_id), store.read_run("stage2", run_id)
        errors = store.current("assessment_errors")
        stats = stores.store_stats(raw, stage1, stage2, assessments, run_id, min_score)
        store.write_run("store_stats", stats, run_id)
        store.write_run("bursts", bursts.burst_events(stores.of_run(raw, run_id)), run_id)

        by_template = collisions.template_members(assessments, run_id, min_score)
        by_vector = durable(
            collisions.semantic_members(stage2, store.current("review_vectors"), assessments, run_id, model)
        )
        template_matches = collisions.same_group(by_template)
        pair_counts = collisions.store_pair_counts(by_template, template_matches, "template").unionByName(
            collisions.similar_store_counts(by_vector, pair_distance)
        )
        store.write_run("pair_counts", pair_counts, run_id)
        if list_pairs:
            pairs = collisions.collision_pairs(by_template, template_matches, "template").unionByName(
                collisions.similar_pairs(by_vector, pair_distance)
            )
            store.write_run("collision_pairs", pairs, run_id)
        store.write_run("edges", collisions.edges_from_counts(store.read_run("pair_counts", run_id)), run_id)
        funnel = stores.funnel(raw, stage1, stage2, assessments, errors, run_id)
        store.write_run("funnel", funnel.withColumn("computed_at", F.current_timestamp()), run_id)

        summary = stores.run_summary(
            store.read_run("store_stats", run_id),
            store.read_run("bursts", run_id),
            store.read_run("pair_counts", run_id),
            store.read_run("edges", run_id),
            store.read_run("funnel", run_id),
            stores.of_run(assessments, run_id),
        )
        counts.update(rows_in=summary.first().n_raw)
        return summary


def run_calibrate(store: ReviewStore, run_id: str, usd_per_row: float | None = None, **choices) -> DataFrame:
    labels = tables.require_rows(stores.of_run(store.current("labels"), run_id), "no labels for this run")
    sweep = calibrate.calibrate(
        labels,
        store.read_run("l2_audit", run_id),
        store.current("assessments"),
        store.read_run("stage2", run_id),
        run_id,
        usd_per_row=usd_per_row,
        **choices,
    )
    store.write_run("calibration", sweep, run_id)
    return calibrate.sweep_table(store.read_run("calibration", run_id))


def load_report(store: ReviewStore, run_id: str, fallback_threshold: float = C.SEED_DISTANCE_THRESHOLD) -> dict[str, DataFrame]:
    """Report tables of a run in report order, with its histograms."""
    funnel = tables.require_rows(
        stores.latest_funnel(store.read_run("funnel", run_id), run_id), f"no funnel for run {run_id}; analyze it first"
    )
    used = stores.of_run(store.runs(), run_id).select("cosine_distance_threshold").first()
    threshold = fallback_threshold if used is None or used[0] is None else used[0]
    raw, assessments = store.current("raw_reviews"), store.current("assessments")
    stage1 = store.read_run("stage1", run_id)
    l1_audit, l2_audit = store.read_run("l1_audit", run_id), store.read_run("l2_audit", run_id)
    return {
        "funnel": funnel,
        "stores": stores.top_stores(store.read_run("store_stats", run_id)),
        "bursts": bursts.flagged_bursts(store.read_run("bursts", run_id)),
        "edges": collisions.top_edges(store.read_run("edges", run_id)),
        "layer1": histograms.hist_l1(l1_audit, raw, run_id),
        "layer2": histograms.hist_l2(l2_audit, stage1, raw, run_id, threshold),
        "layer3": histograms.hist_l3(assessments, raw, run_id),
    }


def export_report(store: ReviewStore, run_id: str, path: str) -> None:
    report = load_report(store, run_id)
    summary = exports.report_summary(
        run_id, report["funnel"], {name: report[name] for name in ("layer1", "layer2", "layer3")}
    )
    exports.export_report_json(summary, {name: report[name] for name in ("stores", "bursts", "edges")}, f"{path}/json")
    exports.export_edges_dot(report["edges"], f"{path}/edges.dot")
