from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.constants import SEED_CATEGORIES
from plumbline.operators import upsert
from plumbline.schemas import RAW_REVIEWS
from plumbline.sources import reviews, tables

SALT = "0123456789abcdef"
GOOD = {
    "native_review_id": "n1", "store_id": "s1", "product_id": "p1", "reviewer_id_raw": "u1", "star_rating": 5,
    "comment_text": "好用 é", "review_ts": "2024-01-02T03:04:05.678Z",
}


def write_lines(folder, lines, name="in.jsonl"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines) + "\n")
    return path


def change(**fields):
    return {k: v for k, v in {**GOOD, **fields}.items() if v != "absent"}


BAD = {
    "star zero": change(star_rating=0),
    "star six": change(star_rating=6),
    "star half": change(star_rating=4.5),
    "star text": change(star_rating="5"),
    "star missing": change(star_rating="absent"),
    "no offset": change(review_ts="2024-01-02T03:04:05"),
    "no such day": change(review_ts="2024-02-31T03:04:05Z"),
    "empty text": change(comment_text=""),
    "number as text": change(store_id=7),
    "url": change(source_url="not a url"),
    "language": change(language_hint="fr"),
    "null language": change(language_hint=None),
    "null marketplace": change(marketplace=None),
    "media text": change(has_media="yes"),
    "empty id": change(native_review_id=""),
    "list": [1],
}
ACCEPTED = [
    GOOD,
    change(native_review_id="absent"),
    change(native_review_id=None),
    change(star_rating=4.0),
    change(review_ts="2024-01-02T03:04+08:00", source_url="https://a.com/x", has_media=True, language_hint="yue", marketplace="m"),
]


def test_bad_lines_are_rejected_and_counted(spark, folder):
    path = write_lines(folder, [*BAD.values(), "{oops", "", "   ", json.dumps(GOOD) + "}", *ACCEPTED])
    parsed = reviews.read_reviews(spark, path)
    counts = reviews.reject_counts(parsed).first().asDict()
    assert counts == {
        "n_read": len(BAD) + 2 + len(ACCEPTED), "n_accepted": len(ACCEPTED), "n_rejected": len(BAD) + 2,
        "n_rejected_json": 2, "n_rejected_schema": len(BAD), "n_rejected_star": 5,
    }
    good, bad = reviews.split_rejects(parsed)
    rows = good.orderBy(*reviews.FILE_ORDER).collect()
    assert [r.star_rating for r in rows] == [5, 5, 5, 4, 5]
    assert rows[0].marketplace == "fixture" and rows[0].has_media is False and rows[4].has_media is True
    assert "line" not in bad.columns
    with pytest.raises(ValueError, match="rejected"):
        reviews.assert_no_rejects(bad)


def test_filters_are_inclusive_and_capped(spark, folder):
    rows = [change(native_review_id=str(i), review_ts=f"2024-01-0{i}T00:00:00Z", store_id=f"s{i % 2}") for i in range(1, 6)]
    good, _ = reviews.split_rejects(reviews.read_reviews(spark, write_lines(folder, rows)))
    ids = lambda df: sorted(r.native_review_id for r in df.collect())
    assert ids(reviews.filter_reviews(good, since="2024-01-02 00:00:00", until="2024-01-04 00:00:00")) == ["2", "3", "4"]
    assert ids(reviews.filter_reviews(good, stores=["s1"], products=["p1"])) == ["1", "3", "5"]
    assert ids(reviews.cap_rows(good, 2)) == ["1", "2"]


def normalized(spark, folder, rows, **kwargs):
    good, _ = reviews.split_rejects(reviews.read_reviews(spark, write_lines(folder, rows)))
    args = {"batch_id": "b1", "run_id": "r1", "ingested_at": "2024-06-01 00:00:00", **kwargs}
    return reviews.normalize_reviews(good, SALT, **args)


def test_normalised_rows_have_no_raw_reviewer_and_last_write_wins(spark, folder):
    rows = [GOOD, change(comment_text="rewritten text"), change(native_review_id="n2"), change(native_review_id=None)]
    made = normalized(spark, folder, rows)
    unique = upsert.last_write_wins(made, "review_id", reviews.FILE_ORDER).drop(*reviews.FILE_ORDER)
    assert unique.columns == RAW_REVIEWS.names
    got = unique.collect()
    assert len(got) == 3
    assert all("u1" not in [v for v in r if isinstance(v, str)] for r in got)
    texts = {r.native_review_id: r.comment_text for r in got}
    assert texts == {"n1": "rewritten text", "n2": "好用 é", None: "好用 é"}
    assert {r.language_hint for r in got} == {"en", "zh-Hant"}


def test_ndjson_round_trip_and_strict_reading(spark, folder):
    made = normalized(spark, folder, [GOOD, change(native_review_id=None)])
    reviews.write_ndjson(made, f"{folder}/out")
    lines = [json.loads(r.value) for r in spark.read.text(f"{folder}/out").collect()]
    assert all(set(line) == set(RAW_REVIEWS.names) for line in lines) and any(line["native_review_id"] is None for line in lines)
    back = reviews.read_normalized(spark, f"{folder}/out").select(*RAW_REVIEWS.names)
    assert sorted(back.collect(), key=str) == sorted(made.select(*RAW_REVIEWS.names).collect(), key=str)

    fine = lines[0]
    broken = {
        "forbidden key reviewer_id_raw": {**fine, "reviewer_id_raw": "u1"},
        "unknown key extra": {**fine, "extra": 1},
        "missing or wrong value: star_rating": {**fine, "star_rating": 9},
        "missing or wrong value: content_hash": {k: v for k, v in fine.items() if k != "content_hash"},
        "not valid JSON": "{",
        "not a JSON object": [1],
    }
    for i, (message, line) in enumerate(broken.items()):
        path = write_lines(folder, [fine, line], f"bad{i}.ndjson")
        with pytest.raises(Exception, match=message):
            reviews.read_normalized(spark, path).collect()


def test_single_batch(spark):
    one = spark.createDataFrame([("a",), ("a",)], "crawl_batch_id string")
    assert tables.assert_single_batch(one) == "a"
    for rows in ([("a",), ("b",)], []):
        with pytest.raises(ValueError):
            tables.assert_single_batch(spark.createDataFrame(rows, "crawl_batch_id string"))


def test_seed_files_as_lines_or_array(spark, folder):
    rows = [{"seed_id": f"s{i}", "category": c, "seed_text": f" text {i} "} for i, c in enumerate(SEED_CATEGORIES)]
    lines = reviews.read_seed_set(spark, write_lines(folder, rows, "a.jsonl"))
    array = reviews.read_seed_set(spark, write_lines(folder, [json.dumps(rows, indent=1)], "b.json"))
    assert sorted(lines.collect()) == sorted(array.collect())
    assert reviews.validate_seed_set(lines).count() == 7 and lines.first().seed_text == "text 0"
    for broken in (rows[:6], rows + rows[:1], [*rows[:6], {**rows[6], "category": rows[0]["category"]}], [{**rows[0], "seed_text": " "}, *rows[1:]]):
        with pytest.raises(ValueError):
            reviews.validate_seed_set(reviews.read_seed_set(spark, write_lines(folder, broken, "c.jsonl")))


def test_label_files(spark, folder):
    rows = [{"review_id": "a", "label": "shill", "stratum": "near_seed"}, {"review_id": "b", "label": "unsure"}]
    assert reviews.validate_labels(reviews.read_labels(spark, write_lines(folder, rows))).count() == 2
    for extra, message in (
        ({"review_id": "a", "label": "shill"}, "duplicate"),
        ({"review_id": "c", "label": "maybe"}, "unknown label"),
        ({"review_id": "c", "label": "shill", "stratum": "x"}, "unknown stratum"),
        ({"label": "shill"}, "missing review_id"),
    ):
        with pytest.raises(ValueError, match=message):
            reviews.validate_labels(reviews.read_labels(spark, write_lines(folder, [*rows, extra], "bad.jsonl")))


def test_run_slices_are_replaced_even_by_nothing(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([("r1", 1), ("r1", 2)], "pipeline_run_id string, x int")
    tables.write_run(df, path, "r1")
    tables.write_run(df.limit(1), path, "r2")
    tables.write_run(df.where("x > 1"), path, "r1")
    assert tables.read_run(spark, path, "r1").count() == 1 and tables.read_run(spark, path, "r2").count() == 1
    tables.write_run(df.where("x > 9"), path, "r1")
    assert tables.read_run(spark, path, "r1").count() == 0 and tables.read_run(spark, path, "r2").count() == 1
    with pytest.raises(ValueError):
        tables.write_run(df, path, "../r1")


def test_versions_may_read_what_they_replace(spark, folder):
    schema = spark.range(1).schema
    path = f"{folder}/v"
    assert tables.read_latest(spark, path, schema).count() == 0
    tables.write_version(spark.range(3), path)
    tables.write_version(tables.read_latest(spark, path, schema).where("id > 0"), path)
    assert sorted(r.id for r in tables.read_latest(spark, path, schema).collect()) == [1, 2]


def test_ledger(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    rows = [
        ("r1", "layer1", "running", "v1", 0.3, "2024-01-01 00:00:00", None),
        ("r1", "layer1", "succeeded", None, None, "2024-01-01 01:00:00", "2024-01-01 01:00:00"),
        ("r2", "layer1", "succeeded", None, None, "2024-01-02 00:00:00", "2024-01-02 00:00:00"),
        ("r3", "layer1", "failed", None, None, "2024-01-03 00:00:00", "2024-01-03 00:00:00"),
    ]
    events = spark.createDataFrame(
        rows, "pipeline_run_id string, phase string, status string, seed_version string, cosine_distance_threshold double, heartbeat_at string, finished_at string"
    ).select(
        "pipeline_run_id", "phase", "status", "seed_version", "cosine_distance_threshold",
        F.col("heartbeat_at").cast("timestamp").alias("heartbeat_at"), F.col("finished_at").cast("timestamp").alias("finished_at"),
        F.lit(None).cast("long").alias("rows_in"), F.lit(None).cast("long").alias("rows_out"),
        F.lit(None).cast("string").alias("error_message"), F.col("heartbeat_at").cast("timestamp").alias("started_at"),
    )
    state = {r.pipeline_run_id: r for r in tables.run_states(events).collect()}
    assert state["r1"].status == "succeeded" and state["r1"].seed_version == "v1" and state["r1"].cosine_distance_threshold == 0.3
    assert tables.latest_run(tables.run_states(events), "layer1").first()[0] == "r2"
    data = spark.createDataFrame([("r1",), ("r2",)], "pipeline_run_id string")
    assert [r[0] for r in tables.latest_run_view(data, tables.run_states(events), "layer1").collect()] == ["r2"]


def test_prechecks(spark):
    with pytest.raises(LookupError):
        tables.require_tables(spark, ["no_such_table"])
    with pytest.raises(LookupError):
        tables.require_columns(spark.range(1), ["x"])
    with pytest.raises(ValueError, match="nothing"):
        tables.require_rows(spark.range(0), "nothing")
    reloaded = tables.reload_version(
        spark.createDataFrame([("a", "v1"), ("b", "v2")], "x string, v string"), spark.createDataFrame([("c",)], "x string"), "v1", "v"
    )
    assert sorted(map(tuple, reloaded.collect())) == [("b", "v2"), ("c", "v1")]
