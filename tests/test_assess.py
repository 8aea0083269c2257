from __future__ import annotations

import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle

from plumbline.operators import assess, upsert
from plumbline.schemas import ASSESSMENT_ERRORS, ASSESSMENTS
from scorers import RuleScorer

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = "Great rice 😀 really great"
BASE = {
    "shill_score": 80, "template_detected": True, "template_id": "t1", "template_name": "n",
    "linguistic_style": "canned_pr", "detected_signals": [], "rationale_short": "why",
}


def clean(spark, *payloads, text=TEXT):
    rows = [(i, text, p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "i int, comment_text string, payload string")
    return assess.sanitize_scores(df, ["t1"]).orderBy("i").collect()


def but(**fields):
    return {k: v for k, v in {**BASE, **fields}.items() if v != "absent"}


def test_scores_are_coerced_like_numbers(spark):
    values = [80, "57.5", 57.4, None, True, "", " 3 ", 100, 100.4, -1, "x", "absent"]
    got = [(r.shill_score if r.schema_error is None else None) for r in clean(spark, *[but(shill_score=v) for v in values])]
    assert got == [80, 58, 57, 0, 1, 0, 3, 100, None, None, None, None]


def test_template_rules(spark):
    cases = [
        (but(), ("t1", "n")),
        (but(template_id="t9"), ("unlisted_template", "n")),
        (but(template_id="unlisted_template"), ("unlisted_template", "n")),
        (but(template_id=""), (None, "n")),
        (but(template_id=5), (None, "n")),
        (but(template_name=5), ("t1", None)),
        (but(template_detected=False), (None, None)),
        (but(template_id="absent", template_name="absent"), (None, None)),
    ]
    got = [(r.template_id, r.template_name) for r in clean(spark, *[c for c, _ in cases])]
    assert got == [w for _, w in cases]


def test_unusable_payloads(spark):
    bad = ["oops", "[1]", "5", but(template_detected="yes"), but(linguistic_style="loud"), but(rationale_short="absent"), but(rationale_short=None)]
    rows = clean(spark, *bad)
    assert all(r.schema_error for r in rows)
    assert [r.schema_error for r in rows[:3]] == ["assessment JSON is not an object"] * 3


def signal(span, start=None, end=None, code="STOCK_PRAISE"):
    out = {"code": code, "span": span}
    if start is not None:
        out.update(start_char=start, end_char=end)
    return out


def test_signals(spark):
    at = TEXT.index("really")
    signals = [
        signal("really", at, at + 6),
        signal("really", at + 1, at + 7),
        signal("really", at, at + 6.5),
        signal("Great", 0, 999),
        signal("rice", code="NOPE"),
        signal("not there"),
        signal(""),
        signal("x" * 81),
        {"span": "rice"},
        "text",
        signal("😀"),
    ]
    row = clean(spark, but(detected_signals=signals))[0]
    assert [(s.span, s.start_char, s.end_char) for s in row.detected_signals] == [
        ("really", at, at + 6), ("really", None, None), ("really", None, None), ("Great", None, None), ("😀", None, None),
    ]
    assert row.signal_span_mismatch_count == 2
    for other in (None, "text", {"a": 1}, "absent"):
        assert clean(spark, but(detected_signals=other))[0].detected_signals == []


def test_everything_is_kept_unless_a_limit_is_given(spark):
    many = [signal("gone")] + [signal("rice")] * 13 + [signal("gone"), signal("y" * 81)]
    payload = but(detected_signals=many, rationale_short="😀" * 150)
    row = clean(spark, payload)[0]
    assert (len(row.detected_signals), row.signal_span_mismatch_count, len(row.rationale_short)) == (13, 3, 150)
    df = spark.createDataFrame([(TEXT, json.dumps(payload))], "comment_text string, payload string")
    row = assess.sanitize_scores(df, ["t1"], max_signals=12, max_span_units=80, max_rationale_units=280).first()
    assert (len(row.detected_signals), row.signal_span_mismatch_count, len(row.rationale_short)) == (12, 1, 140)


def test_score_texts(spark):
    values = ["75d", "75f", "0x4B", " 75 ", "7.5e1", "NaN", "0x"]
    got = [(r.shill_score if r.schema_error is None else None) for r in clean(spark, *[but(shill_score=v) for v in values])]
    assert got == [None, None, 75, 75, 75, None, None]


PENDING = "review_id string, comment_text string, store_id string, product_id string, matched_seed_id string, matched_seed_category string, content_hash string"


class Scripted:
    """Answers by the first word of the text."""

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in rows["comment_text"]:
            kind = text.split()[0]
            if kind == "fail429":
                out.append({"http_status": 429, "error_message": "slow down"})
            elif kind == "fail400":
                out.append({"http_status": 400, "error_message": "no"})
            else:
                payload = "oops" if kind == "bad" else json.dumps({**BASE, "detected_signals": [signal("gone")]})
                out.append({"payload": payload, "input_tokens": 900, "output_tokens": 250, "thought_tokens": 0})
        return pd.DataFrame(out)


def pending(spark, *texts):
    return spark.createDataFrame([(f"r{i}", t, "s", "p", "seed", "c", "h") for i, t in enumerate(texts)], PENDING).repartition(2)


def test_scoring_run(spark):
    rows, errors, counters = assess.score_pending(
        pending(spark, "good one", "bad one", "fail429 x", "fail400 x", "good two"), Scripted(), "run", "x-3.5-flash", "p1", ["t1"], sleep=lambda s: None, partitions=2
    )
    assert rows.columns == ASSESSMENTS.names and errors.columns == ASSESSMENT_ERRORS.names
    assert {r.review_id for r in rows.collect()} == {"r0", "r4"}
    got = {r.review_id: (r.attempt_count, r.http_status, r.error_class, r.retryable) for r in errors.collect()}
    assert got == {"r1": (1, None, "schema", False), "r2": (6, 429, "rate_limit", True), "r3": (1, 400, "unknown", False)}
    c = counters.first()
    assert (c.n_attempted, c.n_scored, c.n_errors, c.error_rate, c.signal_span_mismatch_total) == (5, 2, 3, 0.6, 2)
    assert c.cost_usd_est == pytest.approx(3 * 0.0036)


class Flaky:
    """Fails the first calls of a text with what the text lists."""

    def __init__(self):
        self.calls = {}

    def __call__(self, rows):
        out = []
        for text in rows["comment_text"]:
            n = self.calls[text] = self.calls.get(text, 0) + 1
            failures = text.split()
            if n <= len(failures):
                status, _, after = failures[n - 1].partition(":")
                out.append({"http_status": int(status), "retry_after": float(after) if after else None})
            else:
                out.append({"payload": "{}"})
        return pd.DataFrame(out)


def test_retry_waits_and_stops():
    waits = []
    run = assess.with_retry(Flaky(), 6, waits.append, lambda: 0.0)
    answers = run(pd.DataFrame({"comment_text": ["429 503", "400", "429:7", "", " ".join(["500"] * 9)]}))
    assert answers["attempt_count"].tolist() == [3, 1, 2, 1, 6]
    assert [p == "{}" for p in answers["payload"]] == [True, False, True, True, False]
    assert waits == [7.0, 1.0, 2.0, 4.0, 8.0]
    assert assess.retry_delay(9, None, lambda: 1.0) == 30.25
    from plumbline.functions.scoring import is_retryable

    assert [is_retryable(404, "x"), is_retryable(404, "Timeout"), is_retryable(None, None), is_retryable(505, "")] == [False, True, True, True]


def test_budget_and_limit(spark):
    todo = pending(spark, "good 1", "good 2", "good 3")
    with pytest.raises(assess.OverBudget):
        assess.score_pending(todo, Scripted(), "run", "m", "p", [], max_rows=2)
    rows, _, counters = assess.score_pending(todo, Scripted(), "run", "m", "p", [], limit=2, max_rows=2)
    assert sorted(r.review_id for r in rows.collect()) == ["r0", "r1"]
    assert counters.first().cost_usd_est is None


def test_counters_of_nothing_and_of_hidden_reasoning(spark):
    schema = "called boolean, schema_error string, signal_span_mismatch_count long, input_tokens long, output_tokens long, thought_tokens long"
    none = assess.score_counters(spark.createDataFrame([], schema), "x-3.5-flash").first()
    assert (none.n_attempted, none.error_rate, none.cost_usd_est) == (0, 0.0, None)
    thought = assess.score_counters(spark.createDataFrame([(True, None, 0, 1, 1, 5)], schema), "x-3.5-flash").first()
    assert thought.thinking_not_off and thought.cost_usd_est is None


def scored(spark, rows):
    base = {c: None for c in ASSESSMENTS.names}
    full = [
        {**base, "template_detected": True, "detected_signals": [], "signal_span_mismatch_count": 0, "shill_score": 0, **r, "assessed_at": pd.Timestamp(r["assessed_at"]).to_pydatetime()}
        for r in rows
    ]
    return spark.createDataFrame([tuple(r[c] for c in ASSESSMENTS.names) for r in full], ASSESSMENTS)


def one(review, run, score, when, model="m", prompt="p", content="h", store="old"):
    return {
        "review_id": review, "pipeline_run_id": run, "shill_score": score, "assessed_at": when, "model_id": model, "prompt_version": prompt,
        "content_hash": content, "store_id": store, "product_id": "old", "score_source": "scored",
    }


def test_copy_forward(spark):
    stage2 = spark.createDataFrame([("run", i, "now", "now") for i in "abcde"], "pipeline_run_id string, review_id string, store_id string, product_id string")
    raw = spark.createDataFrame([(i, "h") for i in "abcde"], "review_id string, content_hash string")
    earlier = scored(
        spark,
        [
            one("a", "r1", 10, "2024-01-01"), one("a", "r2", 20, "2024-01-02"), one("b", "r1", 30, "2024-01-01", content="edited"),
            one("c", "r1", 40, "2024-01-01", model="other"), one("d", "run", 50, "2024-01-01"), one("e", "r1", 60, "2024-01-01"),
            one("e", "run", 61, "2024-01-03"), one("e", "r0", 62, "2024-01-02", prompt="other"),
        ],
    )
    found = assess.copy_forward_candidates(stage2, raw, earlier, "run", "m", "p")
    rows = {r.review_id: r for r in found.collect()}
    assert {k: r.shill_score for k, r in rows.items()} == {"a": 20, "e": 60}
    assert (rows["a"].store_id, rows["a"].pipeline_run_id, rows["a"].score_source) == ("now", "run", "copied")
    new = upsert.append_copied(earlier, found)
    assert [r.review_id for r in new.collect()] == ["a"] and upsert.copied_count(new).first().n_copied == 1
    assert assess.count_copy_skips(stage2, raw, earlier, "run", "m", "p").first().n == 1


def test_pending(spark):
    stage2 = spark.createDataFrame(
        [("run", i, "t", "s", "p", "x", "c") for i in "abcd"],
        "pipeline_run_id string, review_id string, comment_text string, store_id string, product_id string, matched_seed_id string, matched_seed_category string",
    )
    raw = spark.createDataFrame([(i, "h") for i in "abcd"], "review_id string, content_hash string")
    done = spark.createDataFrame([("run", "a"), ("old", "b")], "pipeline_run_id string, review_id string")
    errors = spark.createDataFrame([("run", "c", False), ("run", "d", True), ("old", "b", False)], "pipeline_run_id string, review_id string, retryable boolean")
    ids = lambda force: {r.review_id for r in assess.select_pending(stage2, raw, done, errors, "run", force).collect()}
    assert ids(False) == {"b", "d"} and ids(True) == set("abcd")


def test_rule_scorer_output_is_usable(spark):
    df = pending(spark, "the best, I recommend", "plain words")
    rows = assess.sanitize_scores(assess.call_scorer(df, RuleScorer()), ["stock-best"]).orderBy("review_id").collect()
    assert [(r.shill_score, r.template_id, r.schema_error) for r in rows] == [(60, "stock-best", None), (0, None, None)]
    assert [s.start_char for s in rows[0].detected_signals] == [4, 12]
