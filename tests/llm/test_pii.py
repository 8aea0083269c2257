"""Spans against a plain scan of the same texts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from plumbline.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def plain(text: str) -> list[tuple[int, int, int, str]]:
    out = []
    for no, (kind, pattern) in enumerate(BASE.items()):
        out += [(m.start(), no, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return sorted(out)


TEXTS = [
    None,
    "",
    "a@b.com_x@c.de a..b@c-d.e.f @x.y x@y",
    "ü 🙂 4111 1111 1111 1111 then 4111-1111-1111-1112",
    "1.2.3.4.5.6.7.8 256.1.1.1 000000255.0.0.1 01.2.3.4",
    "+1 (555) 123-4567 +49 30 1234567 +1 +12)) +1234567890123456",
    "12 34 5678 9012 3456 7890 1234 5678",
    "account 4149601755386018 and 4149601755386017",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, DE00370400440532013000",
    "a" * 2_000 + "@" + "1" * 2_000 + "." * 100,
    "7-" * 5_000 + " x@y.z " * 3,
    "same@same.org",
    "same@same.org",
]


@pytest.fixture(scope="module")
def results(spark):
    random.seed(4)
    parts = ["a@b.c", "1.2.3.4", "4111111111111111", "+4930123456", " ", "-", ".", "@", "9", "é", "+", "(", "card "]
    texts = TEXTS + ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(300)]
    rows = [(i if i else None, text, "de", "row") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row string").repartition(3)
    return texts, {r["doc_id"] or 0: r for r in pii.digests(docs).collect()}, docs


def test_base_spans_equal_a_plain_scan(results):
    texts, got, _ = results
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text)
        shown = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in want)
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), (text or "")[:200]
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(w[3] == k for w in want) for k in BASE]
        assert set(filter(None, shown.split(","))) <= set(got[i]["spans"].split(","))


def test_method_adds_accounts_and_ibans(results):
    _, got, _ = results
    assert got[7]["spans"] == "account:8:24,card:29:45" and got[7]["n_card"] == 1
    assert got[8]["spans"].count("iban") == 2


def test_redaction_leaves_nothing_of_the_spans(results):
    _, _, docs = results
    out = pii.redact(docs).collect()
    assert {r["text"] for r in out if r["doc_id"] is None} == {None}
    for r in out:
        assert not [s for s in plain(r["text"]) if s[3] != "ip"] or "]" in r["text"]
    by_id = {r["doc_id"]: r["text"] for r in out}
    assert by_id[3].startswith("ü 🙂 [CARD] then 4111-1111") or "[ACCOUNT]" in by_id[3]
    assert by_id[11] == "[EMAIL]"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digests(docs).collect() == [] and pii.redact(docs).collect() == []


def test_very_long_runs_take_linear_time(spark):
    text = "a" * 1_000_000 + "@" + "1" * 1_000_000 + "." * 1000 + "7-" * 500_000 + " x@y.zz 1.2.3.4" * 2_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.digests(docs).first()
    assert (row["n_email"], row["n_ip"], row["n_card"]) == (2_000, 2_000, 0)
