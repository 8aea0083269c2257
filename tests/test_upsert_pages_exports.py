from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import upsert
from plumbline.schemas import RAW_REVIEWS
from plumbline.sources import exports, pages

# -- upsert ------------------------------------------------------------------


def table(spark, rows):
    """rows: (review_id, text hash, star, store, run, updated)."""
    df = spark.createDataFrame(rows, "review_id string, content_hash string, star_rating long, store_id string, pipeline_run_id string, updated_at string")
    df = df.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_REVIEWS.fields if f.name not in df.columns]
    return df.select("*", *missing).select(*RAW_REVIEWS.names)


def shown(df):
    return {r.review_id: (r.content_hash, r.star_rating, r.store_id, r.pipeline_run_id) for r in df.collect()}


def test_upsert_and_preview(spark):
    target = table(spark, [("a", "h1", 5, "s1", "r1", "2024-01-01"), ("b", "h1", 5, "s1", "r1", "2024-01-01"), ("k", "h1", 5, "s1", "r1", "2024-01-01")])
    batch = table(spark, [("a", "h2", 1, "s9", "r2", "2024-02-01"), ("b", "h1", 1, "s9", "r2", "2024-02-01"), ("c", "h3", 4, "s3", "r2", "2024-02-01")])
    result = upsert.upsert_reviews(target, batch)
    want = {"a": ("h2", 1, "s1", "r2"), "b": ("h1", 5, "s1", "r1"), "k": ("h1", 5, "s1", "r1"), "c": ("h3", 4, "s3", "r2")}
    assert result.count() == 4 and shown(result) == want
    assert shown(upsert.upsert_reviews(result, batch)) == want
    preview = upsert.merge_preview(batch, target)
    assert {r.review_id: r.op for r in preview.collect()} == {"a": "update", "b": "unchanged", "c": "insert"}
    assert tuple(upsert.merge_stats(preview).first()) == (1, 1, 1, 1)
    vectors = spark.createDataFrame([("a", 1), ("b", 2)], "review_id string, v int")
    assert [r.review_id for r in upsert.drop_vectors(vectors, upsert.updated_ids(preview)).collect()] == ["b"]
    assert shown(upsert.upsert_reviews(target.limit(0), batch)).keys() == {"a", "b", "c"}


def test_latest_per_key_breaks_ties_the_same_way(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    for parts in (1, 5):
        got = upsert.latest_per_key(df.repartition(parts), "k", ["o"])
        assert sorted(map(tuple, got.collect())) == [("a", 2, "z"), ("b", 0, "m")]


def test_rows_without_key_never_collapse(spark):
    df = spark.createDataFrame([("n1", 1), ("n1", 2), (None, 3), (None, 3), ("", 4), ("", 4)], "native_review_id string, line int")
    got = sorted((r.native_review_id or "", r.line) for r in upsert.merge_harvests(df, ["line"]).collect())
    assert got == [("", 3), ("", 3), ("", 4), ("", 4), ("n1", 2)]


def test_assessments_replace_and_clear_errors(spark):
    keys = "pipeline_run_id string, review_id string, "
    target = spark.createDataFrame([("r", "a", 1), ("r", "b", 2)], keys + "shill_score int")
    rows = spark.createDataFrame([("r", "b", 3), ("r", "c", 4)], keys + "shill_score int")
    errors = spark.createDataFrame([("r", "b", "x"), ("r", "d", "x"), ("old", "b", "x")], keys + "error_class string")
    kept, left = upsert.upsert_assessments(target, rows, errors)
    assert sorted(map(tuple, kept.collect())) == [("r", "a", 1), ("r", "b", 3), ("r", "c", 4)]
    assert sorted(map(tuple, left.collect())) == [("old", "b", "x"), ("r", "d", "x")]
    assert upsert.append_errors(left, errors).count() == 5


def test_seeds_and_labels(spark):
    seeds = spark.createDataFrame(
        [("s", "c", "t", "v1", True)], "seed_id string, category string, seed_text string, seed_version string, is_active boolean"
    ).withColumn("created_at", F.current_timestamp())
    rows = spark.createDataFrame([("s", "c", "new")], "seed_id string, category string, seed_text string")
    state = lambda df: sorted((r.seed_version, r.seed_text, r.is_active) for r in df.collect())
    assert state(upsert.upsert_seeds(seeds, rows, "v2")) == [("v1", "t", False), ("v2", "new", True)]
    assert state(upsert.upsert_seeds(seeds, rows, "v2", activate=False)) == [("v1", "t", True), ("v2", "new", True)]
    assert state(upsert.upsert_seeds(seeds, rows, "v1")) == [("v1", "new", True)]
    with pytest.raises(ValueError):
        upsert.upsert_seeds(seeds, rows, "v0_hypothesis")
    labels = spark.createDataFrame(
        [("r", "a", "shill", None, None), ("x", "a", "shill", None, None)], "pipeline_run_id string, review_id string, label string, stratum string, notes string"
    ).withColumn("labeled_at", F.current_timestamp())
    again = spark.createDataFrame([("a", "unsure", None, None), ("b", "shill", None, None)], "review_id string, label string, stratum string, notes string")
    got = sorted((r.pipeline_run_id, r.review_id, r.label) for r in upsert.upsert_labels(labels, again, "r").collect())
    assert got == [("r", "a", "unsure"), ("r", "b", "shill"), ("x", "a", "shill")]


# -- pages -------------------------------------------------------------------


def block(rid='data-reviewid="r1" ', user='data-user="u1"', stars=4, title="nice <i>one</i>", date="2024-01-02", content=""):
    filled = '<span class="star"></span>' * stars
    return (
        f'<div class="x product-review-wrapper" {rid}{user}><div class="product-review-rating">{filled}'
        '<span class="star empty-star"></span><span class="stars"></span></div>'
        f'<div class="review-title">{title}</div><div class="reply">merchant <div>reply</div></div>'
        f'<div class="product-review-content">{content}</div><span class="review-date"> {date} </span></div>'
    )


def test_blocks_and_first_failing_check():
    html = "".join(
        [
            block(),
            block(rid=""),
            block(user='data-user=""'),
            block(stars=0),
            block(stars=6),
            block(title=" &nbsp; "),
            block(date="02/01/2024"),
            block(rid="", stars=0),
            '<div class="product-review-wrapper" data-reviewid="open"><div>',
        ]
    )
    got = pages.page_blocks(html)
    assert [b["reject_reason"] for b in got] == [
        None, "missing_review_id", "missing_reviewer_id", "star_rating", "star_rating", "empty_comment", "bad_date", "missing_review_id",
    ]
    assert (got[0]["star_rating"], got[0]["comment_text"], got[0]["review_date"], got[0]["has_media"]) == (4, "nice one", "2024-01-02", False)


def test_media_and_entities():
    media = lambda c: pages.page_blocks(block(content=c))[0]["has_media"]
    assert media('<img src="/a.jpg">') and not media('<img src="/_ui/a.png">') and not media("<img>") and media('<img src="/_ui/a"><img src="b"/>')
    assert pages.html_text("a&nbsp;&quot;&#65;&#x42;&lt;&gt;&amp;lt;&copy; &#55296;<br/>") == 'a "AB<>&lt;&copy; '


def test_extract_reviews_reads_place_and_local_day(spark):
    rows = [
        (1, "https://x.com/hk/s/S1/main/p/P1?a=1", block() + block(date="2024-02-31")),
        (2, "https://x.com/hk/s/S1/main/p/P1", "<html>no reviews</html>"),
    ]
    good, bad = pages.extract_reviews(spark.createDataFrame(rows, "page_id long, url string, html string"), "shop")
    r = good.first()
    assert good.count() == 1 and (r.store_id, r.product_id, r.marketplace, r.review_ts_text) == ("S1", "P1", "shop", "2024-01-02T00:00:00+08:00")
    assert [tuple(b) for b in bad.select("page_id", "position", "reject_reason").collect()] == [(1, 1, "bad_date")]


def test_pager_facts(spark):
    cases = [
        ('<span class="total">共 39 頁</span><span class="total">共1頁</span>共99頁', 39, None),
        ("<p>共3頁</p><p>共 12 頁</p><b>25</b> 則評論 7 則評論", 12, 25),
        ('<span class="a comment__count"> 8 </span>9 則評論', None, 8),
        ("nothing", None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "html string")
    got = [tuple(r) for r in df.select(pages.page_total(F.col("html")), pages.declared_reviews(F.col("html"))).collect()]
    assert got == [c[1:] for c in cases]


def test_completeness(spark):
    log = [
        ("s", "short", 1, 3, None, 10, None), ("s", "short", 2, 3, None, 10, "end"),
        ("s", "full", 1, 1, 5, 5, "end"),
        ("s", "capped", 1, 9, 90, 10, "max_pages"),
        ("s", "understated", 1, 1, 25, 10, "next_disabled"),
        ("s", "unknown", 1, None, None, 10, "unchanged_ids"),
        ("s", "again", 1, 1, None, 4, None), ("s", "again", 1, 1, None, 4, "end"),
    ]
    df = spark.createDataFrame(log, "store_id string, product_id string, page_no long, page_total long, n_declared_reviews long, n_accepted long, stopped_reason string")
    got = {r.product_id: (r.n_pages, r.expected_pages, r.is_understated, r.is_short, r.is_incomplete) for r in pages.crawl_completeness(df).collect()}
    assert got == {
        "short": (2, 3, False, True, False), "full": (1, 1, False, False, False), "capped": (1, 9, False, False, True),
        "understated": (1, 3, True, True, True), "unknown": (1, None, False, False, True), "again": (1, 1, False, False, False),
    }


# -- exports -----------------------------------------------------------------


def test_dot_document(spark, folder):
    edges = spark.createDataFrame([('a"b', "c\\d", 2), ("x", "y", 10), ("p", "q", 2)], "src_store_id string, dst_store_id string, weight long")
    exports.export_edges_dot(edges, f"{folder}/dot")
    text = "\n".join(r.value for r in spark.read.text(f"{folder}/dot").collect())
    assert text.splitlines() == [
        "graph {", "  graph [overlap=false];", '  "x" -- "y" [label=10];', '  "a\\"b" -- "c\\\\d" [label=2];', '  "p" -- "q" [label=2];', "}",
    ]
    exports.export_edges_dot(edges.limit(0), f"{folder}/empty")
    assert [r.value for r in spark.read.text(f"{folder}/empty").collect()] == ["graph {", "  graph [overlap=false];", "}"]


def test_report_json(spark, folder):
    funnel = spark.createDataFrame([("r", 3, None)], "pipeline_run_id string, n_raw long, pct_stage1 double")
    histogram = spark.createDataFrame([(1, "b", 2), (0, "a", 1)], "position int, bucket string, n long")
    summary = exports.report_summary("r", funnel, {"layer1": histogram})
    exports.export_report_json(summary, {"edges": funnel}, f"{folder}/report")
    row = json.loads(spark.read.text(f"{folder}/report/summary").first().value)
    assert row["funnel"] == {"n_raw": 3, "pct_stage1": None} and row["layer1"] == [{"bucket": "a", "n": 1}, {"bucket": "b", "n": 2}]
    assert row["disclaimer_en"].startswith("Statistics") and spark.read.json(f"{folder}/report/edges").count() == 1


def test_pager_spans(spark):
    cases = [
        ('<SPAN id="a" class="x total y">3 pages <span>4</span> 9 pages</SPAN>', None),
        ('<span class="comment__count">\n 12 </span><span class="comment__count">13</span>', 12),
        ('<span class="comment__count">n</span><span data-x="1" class="a comment__count"> 14<b>x</b></span>', 14),
        ('<span class="comment__counts">15</span><span title="comment__count">16</span>', None),
        ('<span class="comment__count">17', 17),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i int, html string")
    got = [r.n for r in df.select("i", pages.declared_reviews(F.col("html")).alias("n")).orderBy("i").collect()]
    assert got == [n for _, n in cases]
    texts = df.select(pages._span_texts(F.col("html"), "total").alias("t"), "i").orderBy("i").collect()
    assert texts[0].t == ["3 pages <span>4"] and texts[1].t == []


# -- sizes -------------------------------------------------------------------


def test_small_changes_stream_the_table(spark):
    from plumbline.operators.sizing import small_side

    target = table(spark, [("a", "h1", 5, "s1", "r1", "2024-01-01")])
    plan = upsert.upsert_reviews(target, target)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Union")[0]
    beyond = small_side(spark.range(11), max_bytes=80)
    assert "ResolvedHint" not in beyond._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small_side(spark.range(5), max_bytes=80)._jdf.queryExecution().analyzed().toString()
