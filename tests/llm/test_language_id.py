"""Held-out accuracy, and the fusion against a plain computation."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from plumbline.llm import language_id

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_held_out_accuracy(spark, docs):
    model = language_id.fit(docs.filter("doc_id % 3 <> 0"))
    rest = docs.filter("doc_id % 3 = 0").selectExpr("doc_id", "lang", "text")
    rows = language_id.evidence(rest, model, "text").collect()
    right = sum(r["lang"] == model.languages[max(range(4), key=lambda i: r["text_log"][i])] for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def plain(rows, n):
    shares = []
    for logs, *_ in rows:
        top = [math.exp(x - max(logs)) for x in logs]
        shares.append([t / sum(top) for t in top])
    total = defaultdict(lambda: [0.0] * n)
    for (_, declared, suffix, domain, host), share in zip(rows, shares, strict=True):
        for level, key in (("all", ""), ("declared", declared), ("suffix", suffix), ("domain", domain), ("host", host)):
            if key is not None:
                total[level, key] = [a + b for a, b in zip(total[level, key], share, strict=True)]
    overall = [(c + 1) / (sum(total["all", ""]) + n) for c in total["all", ""]]
    mixed = lambda c, above: [(max(x, 0) + 5 * p) / (sum(c) + 5) for x, p in zip(c, above, strict=True)]
    out = []
    for (logs, declared, suffix, domain, host), share in zip(rows, shares, strict=True):
        prior = overall
        if host is not None:
            above = mixed(total["domain", domain], overall) if domain is not None else overall
            prior = mixed([a - b for a, b in zip(total["host", host], share, strict=True)], above)
        points = [x + math.log(p) for x, p in zip(logs, prior, strict=True)]
        for level, key, weight in (("declared", declared, 1.0), ("suffix", suffix, 0.5)):
            if key is not None:
                points = [x + weight * math.log((c + 5 * p) / p) for x, c, p in zip(points, total[level, key], overall, strict=True)]
        raised = [math.exp(x - max(points)) for x in points]
        out.append([r / sum(raised) for r in raised])
    return out


def test_fusion_equals_a_plain_computation(spark):
    random.seed(1)
    rows = []
    for i in range(120):
        host = random.choice(["a.x.de", "b.x.de", "c.fr", None])
        domain = host and language_id and {"a.x.de": "x.de", "b.x.de": "x.de", "c.fr": "c.fr"}[host]
        rows.append(([random.gauss(0, 2) for _ in range(3)], random.choice(["de", "fr", None]), host and host[-2:], domain, host))
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "text_log array<double>, declared string, suffix string, domain string, host string, id int")
    got = {r["id"]: r for r in language_id.fuse(frame, ["de", "en", "fr"]).collect()}
    assert len(got) == len(rows)
    for i, want in enumerate(plain(rows, 3)):
        assert got[i]["probability"] == pytest.approx(max(want), abs=1e-9)
        assert got[i]["lang"] == ["de", "en", "fr"][want.index(max(want))]


def test_declaration_and_host_decide_where_the_text_does_not(spark, docs):
    german = [r["text"] for r in docs.filter("lang = 'de'").limit(20).collect()]
    page = lambda text: f"<html lang='de-AT'><body><article><p>{text}</p></article></body></html>"
    rows = [(i, f"https://www.site.de/{i}", page(t)) for i, t in enumerate(german)] + [(50, "https://www.site.de/x", page("")), (51, None, None), (None, "no address", "")]
    pages = spark.createDataFrame([(*r, "zz") for r in rows], "page_id long, url string, html string, lang string")
    extra = spark.createDataFrame([(None, None, None, None), (-1, "", "en", "src1")], "doc_id long, text string, lang string, source string")
    out = language_id.identify(docs.select("doc_id", "text", "lang", "source").union(extra), pages).collect()
    assert len(out) == 202 + len(rows)
    found = {r["page_id"]: r for r in out if r["kind"] == "page"}
    assert all(found[i]["lang"] == "de" for i in range(len(german))) and found[50]["lang"] == "de"
    assert found[51]["lang"] == "en" and found[51]["probability"] < 1
    right = docs.select("doc_id", "lang").collect()
    named = {r["doc_id"]: r["lang"] for r in out if r["kind"] == "document"}
    assert sum(named[r["doc_id"]] == r["lang"] for r in right) >= 0.97 * len(right)


def test_empty_tables(spark, docs):
    pages = spark.createDataFrame([(1, "http://a.b", "<p>x</p>")], "page_id long, url string, html string")
    assert language_id.identify(docs.limit(0), pages).collect()[0]["lang"] is None
    assert language_id.identify(docs, pages.limit(0)).count() == 200
