from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import phrases as P
from plumbline.operators import layer1
from plumbline.sources.reviews import delivery_phrases

letters = st.text(alphabet="abAB好快.", min_size=1, max_size=4)


@given(st.lists(letters, min_size=1, max_size=6), st.text(alphabet="abAB好快. ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_cutting_equals_the_longest_first_alternation(phrases, text):
    plain = "|".join(re.escape(p) for p in sorted(phrases, key=lambda p: (-len(p), p)))
    want = re.sub(plain, "", text, flags=re.I)
    folded = P.fold(text)
    found = [
        (i, i + len(p)) for p in {P.fold(q) for q in phrases} for i in range(len(text)) if folded.startswith(p, i)
    ]
    assert P.cut_phrases(text, found) == want


def test_fold_keeps_length():
    for s in ("İstanbul", "straße", "ΟΔΟΣ", "ſK", "好"):
        assert len(P.fold(s)) == len(s)
    assert P.fold("ΟΔΟΣ") == P.fold("οδος")


def test_stripped_lengths(spark):
    texts = ["Fast delivery, well packed", "送貨好快 送貨快", "  nothing here  ", "", "包裝完好無損包裝完好", None]
    words = ["fast delivery", "well packed", "送貨好快", "送貨快", "包裝完好", "包裝完好無損"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(P.stripped_length(F.col("t"), words)).collect()] == [1, 0, 12, 0, 0, None]
    assert [r[0] for r in df.select(P.stripped_length(F.col("t"), [])).collect()] == [26, 8, 12, 0, 10, None]


def test_no_limit_on_phrases(spark):
    many = [f"phrase number {i} of many" for i in range(100_001)]
    df = spark.createDataFrame([("x phrase number 99999 of many y",)], "t string")
    assert df.select(P.stripped_length(F.col("t"), many)).first()[0] == 4


def raw(spark, rows):
    return spark.createDataFrame(
        [("r", f"id{i}", "m", "s", "p", "u", star, text, "h", "en", len(text)) for i, (star, text) in enumerate(rows)],
        "pipeline_run_id string, review_id string, marketplace string, store_id string, product_id string, reviewer_id_hash string, "
        "star_rating long, comment_text string, content_hash string, language_hint string, char_length long",
    ).withColumn("review_ts", F.current_timestamp())


def test_priority_of_reasons_and_filter(spark):
    long = "this product really changed how I cook rice"
    rows = [(4, "x"), (5, "x" * 24), (5, "arrived early " * 3), (5, long), (5, "x" * 25)]
    reviews, phrases = raw(spark, rows), delivery_phrases(spark)
    audit = {r.review_id: r.exclusion_reason for r in layer1.l1_audit(reviews, phrases).collect()}
    assert audit == {"id0": "non_five_star", "id1": "too_short", "id2": "pure_logistics", "id3": "pass", "id4": "pass"}
    kept = layer1.l1_filter(reviews, phrases)
    assert {r.review_id for r in kept.collect()} == {"id3", "id4"}
    summary = layer1.l1_funnel(layer1.l1_audit(reviews, phrases), kept).first().asDict()
    assert summary == {"n_in": 5, "n_non_five_star": 1, "n_too_short": 1, "n_pure_logistics": 1, "n_out": 2}


def test_inactive_and_regexp_phrases_do_nothing(spark):
    phrases = spark.createDataFrame(
        [("abc", "contains", False), (".*", "regexp", True)], "phrase string, match_type string, is_active boolean"
    )
    assert layer1.compile_phrases(layer1.active_phrases(phrases)).first()[0] is None
    got = layer1.with_stripped_length(raw(spark, [(5, "abc.*")]), phrases).first()
    assert got.stripped_char_length == 5


def test_exact_phrases_match_anywhere(spark):
    phrases = spark.createDataFrame([("ABC", "exact", True)], "phrase string, match_type string, is_active boolean")
    assert layer1.with_stripped_length(raw(spark, [(5, "xabcx")]), phrases).first().stripped_char_length == 2


def test_filter_calls_the_search_once(spark):
    plan = layer1.l1_filter(raw(spark, [(5, "a" * 30)]), delivery_phrases(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_blocks_of_phrases_equal_one_automaton(spark):
    random.seed(6)
    some = [f"{a}{b} {c}" for a in "abcdefghij" for b in range(200) for c in range(100)]
    some += ["送貨好快", "送貨", "a1 5 b2", "A1 5 B2 17", "好", "x" * 300]
    assert len(some) > 200_000
    texts = [" ".join(random.choice([random.choice(some), "w", "送貨好快", "A1 5 b2 17"]) for _ in range(random.randint(0, 12))) for _ in range(300)]
    reviews = raw(spark, [(5, t) for t in texts]).unionAll(raw(spark, [(5, "送貨 好")]))
    reviews = reviews.unionAll(reviews.limit(5)).withColumn("hits", F.lit(1))
    reviews = reviews.unionAll(reviews.limit(3).withColumn("comment_text", F.lit(None).cast("string")).withColumn("review_id", F.lit(None).cast("string")))
    phrases = spark.createDataFrame([(p, "contains", True) for p in some], "phrase string, match_type string, is_active boolean")
    key = lambda df: sorted((r.review_id or "", r.comment_text or "", -1 if r.stripped_char_length is None else r.stripped_char_length) for r in df.collect())
    size = sum(len(p.encode()) for p in some)
    one = layer1.with_stripped_length(reviews, phrases, size)
    many = layer1.with_stripped_length(reviews, phrases, size // 3 - 1)
    assert many.columns == one.columns
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" in plan
    assert key(many) == key(one) and any(n not in (-1, 0) for _, _, n in key(one))
    assert layer1.l1_filter(reviews, phrases, min_chars=1).count() > 0


def test_texts_are_made_a_slice_at_a_time(spark):
    """Python holds a bounded part of a batch, and a batch is bounded by bytes."""
    import pyarrow as pa

    from plumbline.functions.slices import slices, values

    texts = pa.array(["x" * 1000, None, ""] * 400)
    parts = list(slices(texts, 20_000))
    assert max(p.nbytes for p in parts) < 40_000 and pa.concat_arrays(parts) == texts
    assert list(values(texts, 20_000)) == texts.to_pylist() and list(slices(texts.slice(0, 0))) == []
    assert all(len(p) == 1 for p in slices(pa.array(["y" * 100] * 3), 10))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 8 << 20
