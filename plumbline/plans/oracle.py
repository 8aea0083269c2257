"""The catalog's queries as plain SQL over the sample tables, for cross-checking.

Written from the definitions, not from the Spark plans: baselines are range
self-joins, edges come from listed pairs, nearest seeds from ranked full lists.
"""

from __future__ import annotations

# Shared relations; each names the ones it reads. They mirror ``sample_views``.
VIEWS: dict[str, tuple[list[str], str]] = {
    "docs": ([], r"""
        SELECT *, sha256(comment_text) AS content_hash, length(comment_text) AS char_length FROM (
          SELECT doc_id, 'run-1' AS pipeline_run_id, sha256('v1|docs|' || doc_id) AS review_id, 'docs' AS marketplace,
            source AS store_id, source || '/' || lang AS product_id, sha256('user-' || (doc_id % 97)) AS reviewer_id_hash,
            CASE WHEN doc_id % 10 < 7 THEN 5 ELSE doc_id % 4 + 1 END AS star_rating,
            trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g')) AS comment_text,
            TIMESTAMP '2024-01-01' + to_seconds(doc_id * 997 % 2592000) AS review_ts, lang AS language_hint
          FROM documents)"""),
    "raw": (["docs"], """
        SELECT * REPLACE (CASE WHEN doc_id % 17 = 0 THEN 'run-2' ELSE 'run-1' END AS pipeline_run_id) FROM docs"""),
    "owned": (["raw"], "SELECT review_id FROM raw WHERE pipeline_run_id = 'run-1'"),
    "ev_user": ([], """
        SELECT CAST(user_id AS VARCHAR) AS store_id, event_type AS product_id, CASE WHEN value < 150 THEN 5 ELSE 3 END AS star_rating,
          ts AS review_ts FROM events"""),
    "ev_type": ([], """
        SELECT event_type AS store_id, event_type || '/u' || (user_id % 3) AS product_id,
          CASE WHEN value < 150 THEN 5 ELSE 3 END AS star_rating, ts AS review_ts FROM events"""),
    "phrases": ([], r"""
        SELECT t AS phrase,
          CASE WHEN item_id % 7 = 0 THEN 'regexp' WHEN item_id % 3 = 0 THEN 'exact' ELSE 'contains' END AS match_type,
          item_id % 5 <> 0 AS is_active
        FROM (SELECT item_id, trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g')) AS t FROM benchmark)"""),
    "pattern": (["phrases"], r"""
        SELECT string_agg(regexp_replace(phrase, '([\\.^$|?*+()\[\]{}])', '\\\1', 'g'), '|' ORDER BY length(phrase) DESC, phrase) AS pattern
        FROM phrases WHERE is_active AND match_type IN ('contains', 'exact')"""),
    "l1": (["docs", "pattern"], r"""
        SELECT *, CASE WHEN star_rating <> 5 THEN 'non_five_star' WHEN char_length < 500 THEN 'too_short'
          WHEN stripped_char_length < 500 THEN 'pure_logistics' ELSE 'pass' END AS exclusion_reason
        FROM (SELECT docs.*, length(trim(CASE WHEN pattern IS NULL THEN comment_text
            ELSE regexp_replace(comment_text, pattern, '', 'gi') END)) AS stripped_char_length FROM docs CROSS JOIN pattern)"""),
    "stage1": (["l1"], "SELECT * FROM l1 WHERE exclusion_reason = 'pass'"),
    "vectors": (["docs"], """
        SELECT CASE WHEN vec_id % 4 = 0 THEN 'run-0' ELSE 'run-1' END AS pipeline_run_id, vec_id, label, review_id, store_id, product_id,
          CASE WHEN vec_id % 13 = 0 THEN 'old' ELSE content_hash END AS content_hash,
          CASE WHEN vec_id % 11 = 0 THEN CAST([] AS DOUBLE[]) ELSE CAST(embedding AS DOUBLE[]) END AS embedding,
          CASE WHEN vec_id % 19 = 0 THEN 'm0' ELSE 'm1' END AS embedding_model,
          CASE WHEN vec_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status
        FROM embeddings JOIN docs ON doc_id = vec_id"""),
    "seeds": ([], """
        SELECT 'seed-' || label AS seed_id,
          ['personal_trial', 'skin_result', 'repurchase', 'social_proof', 'value_for_money', 'brand_comparison', 'packaging_care'][label % 7 + 1] AS category,
          label <> 9 AS is_active, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS embedding
        FROM embeddings GROUP BY label"""),
    "l2": (["stage1", "vectors", "seeds"], """
        SELECT * FROM (
          SELECT s.pipeline_run_id, s.review_id, s.store_id, s.product_id, s.comment_text, s.review_ts, e.seed_id AS matched_seed_id,
            e.category AS matched_seed_category, list_cosine_distance(v.embedding, e.embedding) AS d,
            row_number() OVER (PARTITION BY s.review_id ORDER BY list_cosine_distance(v.embedding, e.embedding), e.seed_id) AS rn
          FROM vectors v JOIN stage1 s ON s.review_id = v.review_id JOIN seeds e ON e.is_active
          WHERE v.status = 'ok' AND v.embedding_model = 'm1') WHERE rn = 1"""),
    "stage2": (["l2"], "SELECT * FROM l2 WHERE d <= 0.75"),
    "assessments": (["vectors"], """
        SELECT vec_id, review_id, run AS pipeline_run_id, store_id, product_id, content_hash, vec_id * factor % 101 AS shill_score,
          vec_id % 3 <> 0 AS template_detected,
          CASE WHEN vec_id % 3 <> 0 THEN CASE WHEN label = 9 THEN 'unlisted_template' ELSE 'tpl-' || label END END AS template_id,
          CASE WHEN vec_id % 5 = 0 THEN 'm2' ELSE 'm1' END AS model_id, CASE WHEN vec_id % 7 = 0 THEN 'p2' ELSE 'p1' END AS prompt_version,
          CASE WHEN vec_id % 8 = 1 THEN 'copied' ELSE 'scored' END AS score_source, vec_id % 900 AS input_tokens, vec_id % 250 AS output_tokens,
          day + to_seconds(vec_id) AS assessed_at, vec_id % 2 AS signal_span_mismatch_count
        FROM vectors JOIN (VALUES ('run-1', 37, TIMESTAMP '2024-03-01'), ('run-0', 53, TIMESTAMP '2024-02-01'), ('run-00', 71, TIMESTAMP '2024-01-01'))
          AS r(run, factor, day) ON (run = 'run-1' AND vec_id % 4 <> 3) OR (run = 'run-0' AND vec_id % 2 = 1) OR (run = 'run-00' AND vec_id % 3 <> 1)"""),
    "mine": (["assessments"], "SELECT * FROM assessments WHERE pipeline_run_id = 'run-1'"),
    "errors": (["docs"], "SELECT review_id, pipeline_run_id, doc_id % 12 = 5 AS retryable FROM docs WHERE doc_id % 6 = 5"),
    "human": ([], """
        SELECT sha256('v1|docs|' || doc_id) AS review_id, CASE WHEN quality = 0 THEN 'shill' WHEN toxic = 1 THEN 'unsure' ELSE 'not_shill' END AS label
        FROM labels"""),
    "tpairs": (["mine"], """
        SELECT a.store_id AS store_id_a, b.store_id AS store_id_b, a.review_id AS review_id_a, b.review_id AS review_id_b, a.template_id,
          CAST(NULL AS DOUBLE) AS cosine_distance, a.shill_score AS shill_score_a, b.shill_score AS shill_score_b, 'template' AS pair_type
        FROM mine a JOIN mine b ON a.template_id = b.template_id AND a.store_id < b.store_id
        WHERE a.template_detected AND b.template_detected AND a.template_id <> 'unlisted_template' AND a.shill_score >= 50 AND b.shill_score >= 50"""),
    "suspects": (["stage2", "vectors", "mine"], """
        SELECT s.store_id, s.review_id, v.embedding, m.shill_score FROM stage2 s
        JOIN vectors v ON v.review_id = s.review_id AND v.pipeline_run_id = 'run-1' AND v.status = 'ok' AND v.embedding_model = 'm1'
        LEFT JOIN mine m ON m.review_id = s.review_id"""),
    "spairs": (["suspects"], """
        SELECT a.store_id AS store_id_a, b.store_id AS store_id_b, a.review_id AS review_id_a, b.review_id AS review_id_b,
          CAST(NULL AS VARCHAR) AS template_id, list_cosine_distance(a.embedding, b.embedding) AS cosine_distance,
          a.shill_score AS shill_score_a, b.shill_score AS shill_score_b, 'embedding' AS pair_type
        FROM suspects a JOIN suspects b ON a.store_id < b.store_id WHERE list_cosine_distance(a.embedding, b.embedding) <= 0.85"""),
    "known": (["docs"], """
        SELECT review_id, 'docs' AS marketplace, CAST(doc_id AS VARCHAR) AS native_review_id, store_id, product_id, reviewer_id_hash, star_rating,
          content_hash, review_ts, TIMESTAMP '2024-04-01' AS ingested_at, 'b1' AS crawl_batch_id, 'run-1' AS pipeline_run_id,
          CAST(NULL AS VARCHAR) AS source_url_hash, language_hint, doc_id % 2 = 0 AS has_media, sha256('b1' || doc_id) AS raw_payload_hash,
          char_length, TIMESTAMP '2024-04-01' AS updated_at
        FROM docs WHERE doc_id % 3 <> 1"""),
    "batch": (["docs"], """
        SELECT review_id, 'docs' AS marketplace, CAST(doc_id AS VARCHAR) AS native_review_id, store_id, product_id, reviewer_id_hash,
          CASE WHEN doc_id % 5 = 0 THEN 1 ELSE star_rating END AS star_rating, sha256(t) AS content_hash, review_ts,
          TIMESTAMP '2024-05-01' AS ingested_at, 'b2' AS crawl_batch_id, 'run-2' AS pipeline_run_id, CAST(NULL AS VARCHAR) AS source_url_hash,
          language_hint, doc_id % 2 = 0 AS has_media, sha256('b2' || doc_id) AS raw_payload_hash, length(t) AS char_length, TIMESTAMP '2024-05-01' AS updated_at
        FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN comment_text || ' (edited)' ELSE comment_text END AS t FROM docs)"""),
    "preview": (["batch", "known"], """
        SELECT b.review_id, CASE WHEN k.review_id IS NULL THEN 'insert' WHEN k.content_hash <> b.content_hash THEN 'update' ELSE 'unchanged' END AS op
        FROM batch b LEFT JOIN known k ON k.review_id = b.review_id"""),
    "runs": ([], """
        SELECT 'run-' || strftime(h, '%Y%m%d%H') AS pipeline_run_id, ['load', 'layer1', 'layer2'][CAST(epoch(h) / 3600 AS BIGINT) % 3 + 1] AS phase,
          CASE WHEN CAST(epoch(h) / 3600 AS BIGINT) % 5 = 0 THEN 'failed' ELSE 'succeeded' END AS status, h AS finished_at, rows_out
        FROM (SELECT date_trunc('hour', ts) AS h, count(*) AS rows_out FROM events GROUP BY 1)"""),
    "lines": (["docs"], """
        SELECT *, CASE WHEN doc_id % 9 = 7 THEN 'json' WHEN doc_id % 9 IN (1, 2, 3, 5) THEN 'schema' END AS reject_reason,
          CASE WHEN doc_id % 9 = 4 THEN review_ts - INTERVAL 8 HOUR ELSE review_ts END AS ts FROM docs"""),
}


def _with(sql: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in VIEWS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered) + "\n" + sql


def _burst(source: str, unit: str, by_product: bool) -> str:
    product = ", product_id" if by_product else ""
    same = "AND p.product_id = d.product_id" if by_product else ""
    flag = (
        "coalesce(z >= 3 AND n_reviews >= 10, FALSE)"
        if unit == "day"
        else "total >= 5 AND n_reviews >= 8 AND n_five_star / n_reviews >= 0.9"
    )
    return f"""
      SELECT store_id, {'product_id' if by_product else 'CAST(NULL AS VARCHAR) AS product_id'}, bucket_ts, '{unit}' AS granularity, n_reviews, n_five_star,
        round(m, 6) AS baseline_mean, round(sd, 6) AS baseline_stddev, round(z, 6) AS z_score, {flag} AS is_burst
      FROM (
        SELECT *, CASE WHEN nb < 5 OR sd IS NULL OR sd = 0 THEN NULL ELSE (n_reviews - m) / sd END AS z,
          count(*) OVER (PARTITION BY store_id{product}) AS total
        FROM (
          SELECT d.*, avg(p.n_reviews) AS m, stddev_samp(p.n_reviews) AS sd, count(p.bucket_ts) AS nb
          FROM (SELECT store_id{product}, date_trunc('{unit}', review_ts) AS bucket_ts, count(*) AS n_reviews, count(*) FILTER (star_rating = 5) AS n_five_star
                FROM {source} GROUP BY ALL) d
          LEFT JOIN (SELECT store_id{product}, date_trunc('{unit}', review_ts) AS bucket_ts, count(*) AS n_reviews FROM {source} GROUP BY ALL) p
            ON p.store_id = d.store_id {same} AND p.bucket_ts >= d.bucket_ts - INTERVAL 14 DAY AND p.bucket_ts < d.bucket_ts
          GROUP BY ALL))"""


def _all_bursts(source: str) -> str:
    return " UNION ALL ".join(_burst(source, unit, by) for unit in ("day", "hour") for by in (False, True))


def _counts(source: str) -> str:
    parts = [
        f"""SELECT store_id, {'product_id' if by else 'CAST(NULL AS VARCHAR) AS product_id'}, '{'product' if by else 'store'}' AS level,
        '{unit}' AS granularity, date_trunc('{unit}', review_ts) AS bucket_ts, count(*) AS n_reviews, count(*) FILTER (star_rating = 5) AS n_five_star
        FROM {source} GROUP BY ALL"""
        for unit in ("day", "hour")
        for by in (False, True)
    ]
    return " UNION ALL ".join(parts)


_AUDIT = """review_id, store_id, product_id, matched_seed_id, matched_seed_category, round(d, 6) AS min_cosine_distance,
  round(1 - d, 6) AS min_cosine_similarity"""
_FUNNEL = """
  SELECT *, n_stage1 / nullif(n_raw, 0) AS pct_stage1, n_stage2 / nullif(n_raw, 0) AS pct_stage2_of_raw, n_stage2 / nullif(n_stage1, 0) AS pct_stage2_of_stage1
  FROM (SELECT (SELECT count(*) FROM owned) AS n_raw, (SELECT count(*) FROM stage1 WHERE review_id IN (FROM owned)) AS n_stage1,
    (SELECT count(*) FROM stage2 WHERE review_id IN (FROM owned)) AS n_stage2, (SELECT count(*) FROM mine WHERE review_id IN (FROM owned)) AS n_assessed,
    (SELECT count(*) FROM errors WHERE review_id IN (FROM owned)) AS n_assess_errors)"""
_STATS = """
  SELECT r.store_id, r.marketplace, r.n_raw, coalesce(s1.n, 0) AS n_stage1, coalesce(s2.n, 0) AS n_stage2, coalesce(a.n, 0) AS n_assessed,
    coalesce(a.hit, 0) AS n_shill_75, a.hit / nullif(a.n, 0) AS pct_shill_75, a.tpl AS n_template_hit, a.tpl / nullif(a.n, 0) AS template_hit_rate,
    s2.d AS avg_min_seed_distance, a.p50 AS p50_shill_score
  FROM (SELECT store_id, min(marketplace) AS marketplace, count(*) AS n_raw FROM raw WHERE pipeline_run_id = 'run-1' GROUP BY store_id) r
  LEFT JOIN (SELECT store_id, count(*) AS n FROM stage1 WHERE review_id IN (FROM owned) GROUP BY store_id) s1 USING (store_id)
  LEFT JOIN (SELECT store_id, count(*) AS n, avg(d) AS d FROM stage2 WHERE review_id IN (FROM owned) GROUP BY store_id) s2 USING (store_id)
  LEFT JOIN (SELECT store_id, count(*) AS n, count(*) FILTER (shill_score >= 75) AS hit, count(*) FILTER (template_detected) AS tpl,
      CAST(quantile_disc(shill_score, 0.5) AS DOUBLE) AS p50 FROM mine WHERE review_id IN (FROM owned) GROUP BY store_id) a USING (store_id)"""
_CONFUSION = """count(*) AS n_labeled, count(*) FILTER (label = 'shill') AS n_shill, count(*) FILTER (label = 'not_shill') AS n_not_shill,
  count(*) FILTER (label = 'unsure') AS n_unsure, count(*) FILTER (label <> 'unsure' AND {yes}) AS n_predicted_positive,
  count(*) FILTER (label = 'shill' AND {yes}) AS n_true_positive, count(*) FILTER (label = 'not_shill' AND {yes}) AS n_false_positive,
  count(*) FILTER (label = 'shill' AND NOT coalesce({yes}, FALSE)) AS n_false_negative"""
_RATES = """round(n_true_positive / nullif(n_true_positive + n_false_positive, 0), 6) AS precision,
  round(n_true_positive / nullif(n_true_positive + n_false_negative, 0), 6) AS recall, n_predicted_stage2, round(n_predicted_stage2 * 0.0036::DOUBLE, 6) AS estimated_usd"""
_EDGES = """SELECT store_id_a AS src_store_id, store_id_b AS dst_store_id, count(*) AS weight,
  coalesce(array_to_string(list_sort(list_distinct(list(template_id) FILTER (template_id IS NOT NULL))), ','), '') AS template_ids FROM {pairs} GROUP BY 1, 2"""
_FAMILY = "['a-3.5-flash', 'a-3.5-flash-lite', 'a-3.1-flash-lite', 'other'][event_id % 4 + 1]"


def _histogram(rows: str, buckets: list[str], only_if_used: tuple[str, ...] = ()) -> str:
    names = ", ".join(f"({i}, '{b}')" for i, b in enumerate(buckets))
    hidden = ", ".join(f"'{b}'" for b in only_if_used) or "''"
    return f"""SELECT b.position, b.bucket, count(r.bucket) AS n FROM (VALUES {names}) AS b(position, bucket)
      LEFT JOIN ({rows}) r ON r.bucket = b.bucket GROUP BY 1, 2 HAVING count(r.bucket) > 0 OR b.bucket NOT IN ({hidden})"""


def _hmac(key: str, message: str) -> str:
    block = key.encode().ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


def oracle_sql(salt: str) -> dict[str, str]:
    json_text = lambda c: f"CAST(to_json({c}) AS VARCHAR)"
    url = """concat(regexp_replace(CASE WHEN page_id % 4 = 0 THEN url || '&gclid=1&Q=a+b' ELSE url END, '#.*$', ''))"""
    doc = "FROM docs"
    return {
        "burst_day_store": _with(_burst("ev_user", "day", False), "ev_user"),
        "burst_day_store_product": _with(_burst("ev_user", "day", True), "ev_user"),
        "burst_hour_store": _with(_burst("ev_type", "hour", False), "ev_type"),
        "burst_hour_store_product": _with(_burst("ev_type", "hour", True), "ev_type"),
        "burst_all": _with(_all_bursts("ev_type"), "ev_type"),
        "burst_flagged": _with(f"SELECT * FROM ({_all_bursts('ev_type')}) WHERE is_burst", "ev_type"),
        "bucket_counts": _with(_counts("raw"), "raw"),
        "l1_pattern": _with("SELECT pattern FROM pattern", "pattern"),
        "l1_audit": _with(
            "SELECT pipeline_run_id, review_id, store_id, star_rating, char_length, stripped_char_length, exclusion_reason FROM l1", "l1"
        ),
        "l1_filter": _with(
            """SELECT pipeline_run_id, review_id, marketplace, store_id, product_id, reviewer_id_hash, star_rating, comment_text, content_hash,
            review_ts, language_hint, char_length, stripped_char_length, 'pass' AS filter_reason FROM stage1""", "stage1"
        ),
        "l1_funnel": _with(
            """SELECT count(*) AS n_in, count(*) FILTER (exclusion_reason = 'non_five_star') AS n_non_five_star,
            count(*) FILTER (exclusion_reason = 'too_short') AS n_too_short, count(*) FILTER (exclusion_reason = 'pure_logistics') AS n_pure_logistics,
            count(*) FILTER (exclusion_reason = 'pass') AS n_out FROM l1""", "l1"
        ),
        "nearest_seed": _with(
            """SELECT review_id, round(d, 6) AS min_cosine_distance, seed_id AS matched_seed_id, category AS matched_seed_category FROM (
            SELECT CAST(vec_id AS VARCHAR) AS review_id, seed_id, category, list_cosine_distance(CAST(v.embedding AS DOUBLE[]), s.embedding) AS d,
              row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_distance(CAST(v.embedding AS DOUBLE[]), s.embedding), seed_id) AS rn
            FROM embeddings v CROSS JOIN seeds s) WHERE rn = 1""", "seeds"
        ),
        "cosine_distance": """SELECT a.vec_id, round(list_cosine_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS distance,
            round(1 - list_cosine_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
            FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "l2_audit": _with(f"SELECT pipeline_run_id, review_ts, 0.75::DOUBLE AS threshold, {_AUDIT} FROM l2", "l2"),
        "stage2": _with(f"SELECT pipeline_run_id, comment_text, review_ts, 0.75::DOUBLE AS threshold, {_AUDIT} FROM stage2", "stage2"),
        "closest": _with(
            """SELECT review_id, matched_seed_id, matched_seed_category, round(d, 6) AS min_cosine_distance, round(1 - d, 6) AS min_cosine_similarity
            FROM stage2 ORDER BY d, review_id LIMIT 10""", "stage2"
        ),
        "l2_funnel": _with(
            """SELECT (SELECT count(*) FROM stage1) AS n_stage1, count(*) FILTER (v.status = 'ok') AS n_embedded_ok,
            count(*) FILTER (v.status = 'error') AS n_embedded_err, (SELECT count(*) FROM stage2) AS n_suspicious
            FROM stage1 s LEFT JOIN vectors v ON v.review_id = s.review_id AND v.embedding_model = 'm1'""", "stage2"
        ),
        "vector_dims": _with(
            """SELECT len(embedding) AS dim, count(*) AS n FROM vectors v WHERE embedding_model = 'm1' AND status = 'ok'
            AND EXISTS (SELECT 1 FROM stage1 s WHERE s.review_id = v.review_id) GROUP BY 1""", "stage1", "vectors"
        ),
        "embed_pending": _with(
            """SELECT review_id, store_id FROM stage1 s WHERE NOT EXISTS (SELECT 1 FROM vectors v
            WHERE v.review_id = s.review_id AND v.embedding_model = 'm1' AND v.status = 'ok')""", "stage1", "vectors"
        ),
        "stale_vectors": _with(
            """SELECT review_id, content_hash, embedding_model, status FROM vectors v WHERE NOT (embedding_model = 'm1' AND EXISTS (
            SELECT 1 FROM stage1 s WHERE s.review_id = v.review_id AND s.content_hash <> v.content_hash))""", "stage1", "vectors"
        ),
        "embed_missing": _with(
            """SELECT review_id, 'ok' AS status, 64::BIGINT AS width, round(sum(n * (cell + 1)) / sqrt(sum(n * n)), 6) AS weighted_sum FROM (
              SELECT review_id, cell, count(*) AS n FROM (
                SELECT review_id, (unicode(comment_text[i]) * 961 + unicode(comment_text[i + 1]) * 31 + unicode(comment_text[i + 2])) % 64 AS cell
                FROM (SELECT review_id, comment_text, unnest(range(1, char_length - 1)) AS i FROM stage1 s WHERE NOT EXISTS (
                  SELECT 1 FROM vectors v WHERE v.review_id = s.review_id AND v.embedding_model = 'm1' AND v.status = 'ok')))
              GROUP BY ALL) GROUP BY review_id""", "stage1", "vectors"
        ),
        "vector_status": _with(
            """SELECT vec_id, CASE WHEN vec_id % 5 <> 0 AND len(embedding) > 0 THEN 'ok' ELSE 'error' END AS status FROM vectors""", "vectors"
        ),
        "template_collisions": _with("SELECT * FROM tpairs", "tpairs"),
        "template_pair_counts": _with(
            "SELECT store_id_a, store_id_b, template_id, count(*) AS n_pairs, 'template' AS pair_type FROM tpairs GROUP BY ALL", "tpairs"
        ),
        "semantic_collisions": _with("SELECT * REPLACE (round(cosine_distance, 6) AS cosine_distance) FROM spairs", "spairs"),
        "edges": _with(
            _EDGES.format(pairs="(SELECT * FROM tpairs UNION ALL SELECT * FROM spairs)"), "tpairs", "spairs"
        ),
        "edges_from_pairs": _with(_EDGES.format(pairs="tpairs"), "tpairs"),
        "store_stats": _with(
            f"""SELECT * REPLACE (round(pct_shill_75, 6) AS pct_shill_75, round(template_hit_rate, 6) AS template_hit_rate,
            round(avg_min_seed_distance, 6) AS avg_min_seed_distance) FROM ({_STATS})""", "owned", "stage2", "mine"
        ),
        "top_stores": _with(
            f"""SELECT store_id, n_shill_75, CASE WHEN pct_shill_75 IS NULL THEN 'n/a' ELSE printf('%.1f%%', pct_shill_75 * 100) END AS pct,
            CASE WHEN p50_shill_score IS NULL THEN 'n/a' ELSE printf('%.1f', p50_shill_score) END AS median
            FROM ({_STATS}) ORDER BY pct_shill_75 DESC NULLS LAST, n_shill_75 DESC, store_id""", "owned", "stage2", "mine"
        ),
        "funnel": _with(
            f"""SELECT * REPLACE (round(pct_stage1, 6) AS pct_stage1, round(pct_stage2_of_raw, 6) AS pct_stage2_of_raw,
            round(pct_stage2_of_stage1, 6) AS pct_stage2_of_stage1), CASE WHEN pct_stage2_of_raw IS NULL THEN 'unknown'
            WHEN pct_stage2_of_raw > 0.15 THEN 'loose' WHEN pct_stage2_of_raw < 0.01 THEN 'tight' ELSE 'ok' END AS tightness FROM ({_FUNNEL})""",
            "owned", "stage2", "mine", "errors",
        ),
        "in_scope": _with("SELECT review_id, exclusion_reason FROM l1 WHERE review_id IN (FROM owned)", "owned", "l1"),
        "run_summary": _with(
            f"""SELECT 1::BIGINT AS n_funnel, n_raw, n_stage1, n_stage2, round(pct_stage2_of_raw, 6) AS pct_stage2_of_raw,
            (SELECT count(DISTINCT store_id) FROM raw WHERE pipeline_run_id = 'run-1') AS n_store_stats,
            (SELECT count(*) FROM ({_all_bursts('ev_type')})) AS n_burst_events, (SELECT count(*) FROM ({_all_bursts('ev_type')}) WHERE is_burst) AS n_burst_flagged,
            (SELECT count(*) FROM tpairs) AS n_collisions, (SELECT count(*) FROM (SELECT DISTINCT store_id_a, store_id_b FROM tpairs)) AS n_edges,
            (SELECT count(*) FROM mine) AS n_assessed FROM ({_FUNNEL})""", "owned", "stage2", "tpairs", "errors", "ev_type"
        ),
        "hist_l1": _with(
            _histogram("SELECT exclusion_reason AS bucket FROM l1 WHERE review_id IN (FROM owned)",
                       ["non_five_star", "too_short", "pure_logistics", "pass"]), "owned", "l1"
        ),
        "l1_coverage": _with(
            """SELECT (SELECT count(*) FROM l1 WHERE review_id IN (FROM owned)) AS n_rows, (SELECT count(*) FROM owned) AS n_in_scope,
            (SELECT count(*) FROM l1 WHERE review_id IN (FROM owned)) = (SELECT count(*) FROM owned) AS coverage_ok""", "owned", "l1"
        ),
        "hist_l2": _with(
            _histogram(
                """SELECT CASE WHEN d < 0.1875 THEN '0.00-0.19' WHEN d < 0.375 THEN '0.19-0.38' WHEN d < 0.5625 THEN '0.38-0.56'
                WHEN d <= 0.75 THEN '0.56-0.75' WHEN d <= 1 THEN '0.75-1.00' ELSE '1.00-2.00' END AS bucket FROM l2 WHERE review_id IN (FROM owned)
                UNION ALL SELECT 'no_distance' FROM stage1 WHERE review_id IN (FROM owned) AND review_id NOT IN (SELECT review_id FROM l2)""",
                ["0.00-0.19", "0.19-0.38", "0.38-0.56", "0.56-0.75", "0.75-1.00", "1.00-2.00", "out_of_range", "no_distance"],
                ("out_of_range",),
            ), "owned", "l2"
        ),
        "l2_totals": _with(
            """SELECT count(*) AS n_with_distance, count(*) FILTER (d BETWEEN 0 AND 0.75) AS n_le_threshold, count(*) FILTER (d > 0.75 AND d <= 2) AS n_gt_threshold
            FROM l2 WHERE review_id IN (FROM owned)""", "owned", "l2"
        ),
        "hist_l3": _with(
            _histogram("""SELECT CASE WHEN shill_score <= 24 THEN '0-24' WHEN shill_score <= 49 THEN '25-49' WHEN shill_score <= 74 THEN '50-74'
                ELSE '75-100' END AS bucket FROM mine WHERE review_id IN (FROM owned)""", ["0-24", "25-49", "50-74", "75-100"]), "owned", "mine"
        ),
        "l3_totals": _with(
            """SELECT count(*) AS n_assessed, count(*) FILTER (score_source = 'scored') AS n_scored, count(*) FILTER (score_source = 'copied') AS n_copied,
            count(*) FILTER (shill_score >= 75) AS n_shill_75 FROM mine WHERE review_id IN (FROM owned)""", "owned", "mine"
        ),
        "calibration": _with(
            f"""SELECT 'layer2_distance' AS metric_kind, t AS cosine_distance_threshold, CAST(NULL AS BIGINT) AS shill_score_threshold,
              n_labeled, n_shill, n_not_shill, n_unsure, n_predicted_positive, n_true_positive, n_false_positive, n_false_negative, {_RATES}
            FROM (SELECT t, {_CONFUSION.format(yes='d <= t')}, (SELECT count(*) FROM l2 WHERE l2.d <= t) AS n_predicted_stage2
              FROM (SELECT unnest([0.6, 0.65, 0.7, 0.75, 0.8, 0.9]::DOUBLE[]) AS t) g CROSS JOIN (SELECT h.*, l2.d FROM human h LEFT JOIN l2 USING (review_id)) GROUP BY t)
            UNION ALL
            SELECT 'layer3_score', 0.75::DOUBLE, 75::BIGINT, n_labeled, n_shill, n_not_shill, n_unsure, n_predicted_positive, n_true_positive, n_false_positive,
              n_false_negative, {_RATES} FROM (SELECT {_CONFUSION.format(yes='shill_score >= 75')}, (SELECT count(*) FROM stage2) AS n_predicted_stage2
              FROM human LEFT JOIN mine USING (review_id))""", "human", "stage2", "mine"
        ),
        "label_summary": _with(
            """SELECT count(*) AS n_labeled, count(*) FILTER (label = 'shill') AS n_shill, count(*) FILTER (label = 'not_shill') AS n_not_shill,
            count(*) FILTER (label = 'unsure') AS n_unsure FROM human""", "human"
        ),
        "raw_dedup": _with("SELECT review_id, content_hash, star_rating, updated_at FROM batch", "batch"),
        "last_write_wins": """SELECT native_review_id, conv_id, turn FROM (
              SELECT conv_id || '-' || role AS native_review_id, conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn
              FROM conversations WHERE conv_id % 3 <> 0) WHERE rn = 1
            UNION ALL SELECT '', conv_id, turn FROM conversations WHERE conv_id % 3 = 0""",
        "merge_preview": _with("SELECT * FROM preview", "preview"),
        "merge_stats": _with(
            """SELECT count(*) FILTER (op = 'insert') AS n_inserted, count(*) FILTER (op = 'update') AS n_updated,
            count(*) FILTER (op = 'unchanged') AS n_unchanged, count(*) FILTER (op = 'unchanged') AS n_already_present FROM preview""", "preview"
        ),
        **dict.fromkeys(("upsert_result", "upsert_stored"), _with(
            """SELECT k.* FROM known k JOIN preview p ON p.review_id = k.review_id WHERE op = 'unchanged'
            UNION ALL BY NAME SELECT b.* FROM batch b JOIN preview p ON p.review_id = b.review_id WHERE op = 'insert'
            UNION ALL BY NAME SELECT b.* REPLACE (k.source_url_hash AS source_url_hash) FROM batch b JOIN preview p ON p.review_id = b.review_id
              JOIN known k ON k.review_id = b.review_id WHERE op = 'update'""", "preview"
        )),
        **dict.fromkeys(("drop_vectors", "drop_vectors_stored"), _with(
            "SELECT review_id, embedding_model, status FROM vectors WHERE review_id NOT IN (SELECT review_id FROM preview WHERE op = 'update')",
            "vectors", "preview",
        )),
        "latest_run": _with(
            "SELECT * FROM runs WHERE phase = 'layer1' AND status = 'succeeded' ORDER BY finished_at DESC LIMIT 1", "runs"
        ),
        "copy_forward": _with(
            """SELECT s.review_id, s.store_id, p.shill_score, p.template_id, 'copied' AS score_source, p.input_tokens
            FROM stage2 s JOIN docs r ON r.review_id = s.review_id JOIN assessments p ON p.review_id = s.review_id AND p.content_hash = r.content_hash
              AND p.model_id = 'm1' AND p.prompt_version = 'p1' AND p.pipeline_run_id <> 'run-1'
            WHERE s.review_id NOT IN (SELECT review_id FROM mine)
            QUALIFY row_number() OVER (PARTITION BY s.review_id ORDER BY p.assessed_at DESC) = 1""", "stage2", "mine"
        ),
        "copy_skips": _with(
            """SELECT count(*) AS n FROM stage2 s JOIN docs r ON r.review_id = s.review_id
            WHERE EXISTS (SELECT 1 FROM assessments p WHERE p.review_id = s.review_id AND p.content_hash = r.content_hash AND p.pipeline_run_id <> 'run-1'
                AND (p.model_id <> 'm1' OR p.prompt_version <> 'p1'))
              AND NOT EXISTS (SELECT 1 FROM assessments p WHERE p.review_id = s.review_id AND p.content_hash = r.content_hash
                AND p.pipeline_run_id <> 'run-1' AND p.model_id = 'm1' AND p.prompt_version = 'p1')""", "stage2", "assessments"
        ),
        "pending": _with(
            """SELECT s.review_id, s.store_id, s.product_id, s.matched_seed_id, s.matched_seed_category, r.content_hash
            FROM stage2 s JOIN docs r ON r.review_id = s.review_id WHERE s.review_id NOT IN (SELECT review_id FROM mine)
              AND s.review_id NOT IN (SELECT review_id FROM errors WHERE NOT retryable)""", "stage2", "mine", "errors"
        ),
        "upsert_assessments": _with(
            """SELECT review_id, shill_score, assessed_at FROM assessments WHERE pipeline_run_id = 'run-0'
            UNION ALL SELECT review_id, shill_score, assessed_at FROM mine
              WHERE review_id NOT IN (SELECT review_id FROM assessments WHERE pipeline_run_id = 'run-0')""", "mine"
        ),
        "open_errors": _with(
            "SELECT review_id, retryable FROM errors WHERE review_id NOT IN (SELECT review_id FROM mine)", "errors", "mine"
        ),
        "sanitize": _with(
            f"""SELECT doc_id, schema_error, CASE WHEN ok THEN CASE WHEN doc_id % 8 = 1 THEN doc_id % 100 + 1 ELSE doc_id % 101 END END AS shill_score,
              CASE WHEN ok AND doc_id % 8 <> 1 THEN CASE doc_id % 8 WHEN 5 THEN 'unlisted_template' WHEN 3 THEN NULL ELSE 'tpl-1' END END AS template_id,
              CASE WHEN ok AND doc_id % 8 <> 1 THEN 'name' END AS template_name, CASE WHEN ok THEN doc_id % 300 END AS rationale_chars,
              CASE WHEN ok THEN CASE doc_id % 8 WHEN 7 THEN 13 ELSE 1 END END::BIGINT AS n_signals,
              CASE WHEN ok THEN CASE doc_id % 8 WHEN 7 THEN 13 WHEN 5 THEN 0 ELSE 1 END END::BIGINT AS n_placed,
              CASE WHEN ok THEN CASE doc_id % 8 WHEN 2 THEN 1 WHEN 7 THEN 2 ELSE 0 END END::BIGINT AS n_mismatched
            FROM (SELECT *, schema_error IS NULL AS ok FROM (SELECT doc_id, CASE WHEN doc_id % 40 IN (4, 12) THEN 'assessment JSON is not an object'
              WHEN doc_id % 8 = 6 THEN 'missing or invalid: shill_score' WHEN doc_id % 16 = 0 THEN 'missing or invalid: linguistic_style' END AS schema_error {doc}))""",
            "docs",
        ),
        "error_class": """SELECT event_id, CASE WHEN st = 429 THEN 'rate_limit' WHEN st BETWEEN 500 AND 504 THEN 'server' WHEN st = 400 THEN 'unknown'
              WHEN event_id % 4 = 0 THEN 'timeout' ELSE 'unknown' END AS error_class,
            coalesce(CASE WHEN st = 400 THEN FALSE WHEN st = 404 THEN event_id % 4 = 0 ELSE TRUE END, TRUE) AS retryable,
            CASE WHEN st = 429 OR st BETWEEN 500 AND 504 OR st = 400 OR (st = 404 AND event_id % 4 <> 0) THEN st END AS http_status
            FROM (SELECT event_id, CAST([429, 500, 504, 505, 400, 404, 200, 503, NULL][event_id % 9 + 1] AS BIGINT) AS st FROM events)""",
        "score_counters": _with(
            """SELECT count(*) AS n_attempted, count(*) FILTER (vec_id % 10 <> 0) AS n_scored, count(*) FILTER (vec_id % 10 = 0) AS n_errors,
            round(count(*) FILTER (vec_id % 10 = 0) / count(*), 6) AS error_rate,
            CAST(sum(signal_span_mismatch_count) FILTER (vec_id % 10 <> 0) AS BIGINT) AS signal_span_mismatch_total, FALSE AS thinking_not_off,
            round(sum(input_tokens / 1e3 * 1.5 + output_tokens / 1e3 * 9.0), 6) AS cost_milli_usd FROM mine""", "mine"
        ),
        "token_cost": f"""SELECT event_id, round(CASE {_FAMILY} WHEN 'a-3.5-flash' THEN event_id % 900 / 1e3 * 1.5 + event_id % 250 / 1e3 * 9.0
            WHEN 'a-3.1-flash-lite' THEN event_id % 900 / 1e3 * 0.25 + event_id % 250 / 1e3 * 1.5 END, 6) AS usd_per_1000 FROM events""",
        "review_ids": _with(
            f"""SELECT doc_id, sha256(CASE WHEN doc_id % 3 = 2 THEN 'v1|docs|' || doc_id ELSE concat_ws('|', 'v1', marketplace, store_id, product_id,
            reviewer_id_hash, content_hash, strftime(review_ts, '%Y-%m-%dT%H:%M:%S.%gZ')) END) AS review_id {doc}""", "docs"
        ),
        "text_norm": r"""SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '[ \t\n\r\f]+', ' ', 'g'))) AS content_hash FROM documents""",
        "language_hint": _with(
            rf"""SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'zh-Hans' WHEN doc_id % 6 = 0 THEN 'mixed' WHEN doc_id % 6 = 1 THEN 'yue' WHEN doc_id % 6 = 2 THEN 'zh-Hant'
              WHEN doc_id % 6 = 3 THEN 'unknown' WHEN regexp_matches(comment_text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS language_hint,
            CASE WHEN doc_id % 6 = 0 THEN char_length + 3 WHEN doc_id % 6 = 1 THEN char_length + 4 WHEN doc_id % 6 = 2 THEN 3 ELSE char_length END AS code_points {doc}""",
            "docs",
        ),
        "canonical_url": f"""SELECT page_id, u AS url, sha256(u) AS url_hash FROM (
              SELECT page_id, regexp_replace(b, '\\?$', '') AS u FROM (SELECT page_id, split_part(x, '?', 1) || CASE WHEN contains(x, '?') THEN '?' || array_to_string(
                list_filter(string_split(split_part(x, '?', 2), '&'), lambda p: p NOT LIKE 'utm_%' AND p NOT LIKE 'gclid%'), '&') ELSE '' END AS b
              FROM (SELECT page_id, {url} AS x FROM pages)))""",
        "pseudonyms": f"SELECT event_id, {_hmac(salt, chr(39) + 'user-' + chr(39) + ' || user_id')} AS reviewer_id_hash FROM events",
        "payload_hash": _with(
            f"""SELECT doc_id, sha256('{{"marketplace":"docs","native_review_id":' || CASE WHEN doc_id % 2 = 0 THEN '"' || doc_id || '"' ELSE 'null' END
            || ',"store_id":' || {json_text('store_id')} || ',"product_id":' || {json_text('product_id')} || ',"star_rating":' || star_rating
            || ',"comment_text":' || {json_text('comment_text')} || ',"review_ts":"' || strftime(review_ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '","source_url":null,"has_media":'
            || CASE WHEN doc_id % 5 = 0 THEN 'true' ELSE 'false' END || CASE WHEN doc_id % 3 = 0 THEN ',"language_hint":' || {json_text('language_hint')} ELSE '' END || '}}')
            AS payload_hash {doc}""", "docs"
        ),
        "parse_reviews": _with(
            """SELECT doc_id AS source_line, reject_reason, reject_reason IS DISTINCT FROM 'json' AND doc_id % 9 = 2 AS reject_star, 'fixture' AS marketplace,
              CASE WHEN doc_id % 9 = 7 THEN NULL WHEN doc_id % 9 = 1 THEN '' ELSE store_id END AS store_id,
              CASE WHEN doc_id % 9 NOT IN (2, 7) THEN CAST(star_rating AS INTEGER) END AS star_rating,
              CASE WHEN doc_id % 9 <> 7 THEN ts END AS review_ts, FALSE AS has_media FROM lines""", "lines"
        ),
        "reject_counts": _with(
            """SELECT count(*) AS n_read, count(*) FILTER (reject_reason IS NULL) AS n_accepted, count(reject_reason) AS n_rejected,
            count(*) FILTER (reject_reason = 'json') AS n_rejected_json, count(*) FILTER (reject_reason = 'schema') AS n_rejected_schema,
            count(*) FILTER (doc_id % 9 = 2) AS n_rejected_star FROM lines""", "lines"
        ),
        "normalize_reviews": _with(
            f"""SELECT sha256('v1|fixture|' || doc_id) AS review_id, store_id, star_rating, content_hash, ts AS review_ts,
            CASE WHEN doc_id % 9 = 6 THEN sha256('https://shop.example.com/?b=2') END AS source_url_hash,
            CASE WHEN regexp_matches(comment_text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS language_hint, char_length
            FROM lines WHERE reject_reason IS NULL""", "lines"
        ),
        "filter_reviews": _with(
            "SELECT doc_id AS source_line, ts AS review_ts FROM lines WHERE reject_reason IS NULL AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'", "lines"
        ),
        "page_reviews": _with(
            f"""SELECT doc_id AS page_id, 'r' || doc_id AS native_review_id, store_id, language_hint AS product_id, 'u' || (doc_id % 97) AS reviewer_id_raw,
              doc_id % 5 + 1 AS star_rating, sha256(comment_text) AS text_hash, date_trunc('day', review_ts) - INTERVAL 8 HOUR AS review_ts, doc_id % 3 = 0 AS has_media {doc}
            UNION ALL SELECT doc_id, 'x' || doc_id, store_id, language_hint, 'u' || (doc_id % 97), 5, sha256('short &lt; text'),
              date_trunc('day', review_ts) - INTERVAL 8 HOUR, FALSE {doc} WHERE doc_id % 6 = 5""", "docs"
        ),
        "page_rejects": _with(
            f"""SELECT ['missing_review_id', 'missing_reviewer_id', 'star_rating', 'empty_comment', 'bad_date'][doc_id % 6 + 1] AS reject_reason, count(*) AS n
            {doc} WHERE doc_id % 6 < 5 GROUP BY 1""", "docs"
        ),
        "page_facts": """SELECT doc_id AS page_id, CASE WHEN doc_id % 10 <> 9 THEN doc_id % 40 END AS page_total,
            CASE WHEN doc_id % 2 = 0 THEN doc_id % 400 ELSE doc_id % 300 END AS n_declared_reviews FROM documents""",
        "page_facts_given": r"""SELECT page_id, list_max([TRY_CAST(x AS BIGINT) FOR x IN regexp_extract_all(regexp_replace(html, '<[^>]+>', ' ', 'g'), '共\s*(\d+)\s*頁', 1)]) AS page_total,
            TRY_CAST(nullif(regexp_extract(regexp_replace(html, '<[^>]+>', ' ', 'g'), '(\d+)\s*則評論', 1), '') AS BIGINT) AS n_declared_reviews FROM pages""",
        "crawl_completeness": """SELECT * EXCLUDE (by_count), coalesce(page_total >= 1 AND page_total < by_count, FALSE) AS is_understated,
              coalesce(stopped_reason IN ('end', 'unchanged_ids', 'next_disabled') AND n_pages < expected_pages, FALSE) AS is_short,
              stopped_reason = 'unchanged_ids' OR coalesce(n_accepted < n_declared_reviews, FALSE) AS is_incomplete
            FROM (SELECT *, greatest(CASE WHEN page_total >= 1 THEN page_total END, by_count) AS expected_pages
              FROM (SELECT *, CASE WHEN n_declared_reviews >= 1 THEN CAST(ceil(n_declared_reviews / 10) AS BIGINT) END AS by_count
                FROM (SELECT CAST(c % 50 AS VARCHAR) AS store_id, CAST(c AS VARCHAR) AS product_id, count(DISTINCT o_orderkey) AS n_pages,
                  CASE WHEN c % 3 <> 0 THEN c % 25 END AS page_total, CASE WHEN c % 4 <> 0 THEN c % 170 END AS n_declared_reviews,
                  CAST(sum(o_orderkey % 11) AS BIGINT) AS n_accepted,
                  ['end', 'unchanged_ids', 'next_disabled', 'max_pages', 'max_reviews'][c % 5 + 1] AS stopped_reason
                FROM (SELECT *, o_custkey AS c FROM orders) GROUP BY c)))""",
        "edges_dot": _with(
            r"""SELECT 0 AS part, 'graph {' || chr(10) || '  graph [overlap=false];' AS line UNION ALL SELECT 2, '}'
            UNION ALL SELECT 1, '  "' || store_id_a || '\"\\" -- "' || store_id_b || '" [label=' || count(*) || '];' FROM tpairs GROUP BY store_id_a, store_id_b""",
            "tpairs",
        ),
    }
