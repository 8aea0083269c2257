from __future__ import annotations

import hashlib
import hmac
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from plumbline.functions import ids, text

SALT = "0123456789abcdef"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_form_c_shortcut_only_skips_stable_characters(spark):
    ranges = [(0, 0x2FF), (0x2010, 0x2027), (0x2030, 0x205E), (0x3001, 0x3003), (0x4E00, 0x9FFF), (0xFF01, 0xFF5E)]
    for low, high in ranges:
        for code in range(low, high + 1):
            c = chr(code)
            assert unicodedata.normalize("NFC", c) == c and unicodedata.combining(c) == 0
    samples = ["é", "한", "Å", "豈", "plain", "好", "", "Å b"]
    assert column(spark, samples, text.form_c) == [unicodedata.normalize("NFC", s) for s in samples]


def test_normalize_text_collapses_every_blank(spark):
    got = column(spark, ["　a \n b﻿", None, "  "], text.normalize_text)
    assert got == ["a b", None, ""]


def test_lengths_count_code_points_and_units(spark):
    assert column(spark, ["😀好"], text.code_points) == [2]
    assert column(spark, ["😀好"], text.utf16_units) == [3]
    assert column(spark, ["ab😀", "abc", "abcd"], lambda c: text.cut_utf16(c, 3)) == ["ab", "abc", "abc"]
    assert column(spark, ["abcd"], lambda c: text.cap_text(c, 2)) == ["ab"]


def test_language_hint(spark):
    values = ["好嘅 ok", "好 ok", "好好", "hello", "123"]
    assert column(spark, values, text.language_hint) == ["yue", "mixed", "zh-Hant", "en", "unknown"]
    assert column(spark, ["x"], lambda c: text.language_hint(c, F.lit("zh-Hans"))) == ["zh-Hans"]


def test_stripped_length(spark):
    length = lambda p: lambda c: text.stripped_length(c, F.lit(p).cast("string"))
    assert column(spark, ["　fast  ", "a fast b"], length("(?iu)FAST")) == [0, 4]
    assert column(spark, [" ab "], length(None)) == [2]


def test_strict_json(spark):
    values = ['{"a":1}', '{"a":1}}', '{"a":1}]', "1,2", "oops", "[1]", '{"a":1} x', "null"]
    got = column(spark, values, lambda c: text.strict_json(c).isNotNull())
    assert got == [True, False, False, False, False, True, False, True]


def test_pseudonym_is_keyed_and_hidden(spark):
    df = spark.createDataFrame([("u1",), (None,)], "v string").select(ids.pseudonymize(F.col("v"), SALT).alias("h"))
    assert [r.h for r in df.collect()] == [hmac.new(SALT.encode(), b"u1", "sha256").hexdigest(), None]
    assert SALT not in df._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        ids.pseudonymize(F.col("v"), "short")
    with pytest.raises(Exception, match="must not be empty"):
        column(spark, [""], lambda c: ids.pseudonymize(c, SALT))


def test_review_id(spark):
    df = spark.createDataFrame(
        [("m", "n1", "s", "p", "h", "c"), ("m", None, "s", "p", "h", "c"), ("m", "", "s", "p", "h", "c")],
        "m string, n string, s string, p string, h string, c string",
    ).withColumn("t", F.lit("2024-01-02 03:04:05.678").cast("timestamp"))
    made = ids.review_id(*[F.col(c) for c in ("m", "n", "s", "p", "h", "c", "t")])
    got = [r[0] for r in df.select(made).collect()]
    without = sha("v1|m|s|p|h|c|2024-01-02T03:04:05.678Z")
    assert got == [sha("v1|m|n1"), without, without]


def test_canonical_url(spark):
    cases = {
        "https://Shop.Example.com?UTM_Source=a&b=2#x": "https://shop.example.com/?b=2",
        "http://a.com:80/p?gclid=1": "http://a.com/p",
        "https://a.com:8443/p?x=1&FBCLID=2&y=a%20b": "https://a.com:8443/p?x=1&y=a+b",
        "https://a.com/p?y=a%20b": "https://a.com/p?y=a%20b",
        "https://a.com/p?_ga=1&flag": "https://a.com/p?flag=",
        "mailto:a@b.c": "mailto:a@b.c",
    }
    assert column(spark, list(cases), ids.canonical_url) == list(cases.values())
    assert column(spark, [None, "https://a.com/"], ids.url_hash) == [None, sha("https://a.com/")]
    assert column(spark, ["nope", "https://", "http://a b/"], ids.is_url) == [False, False, False]
    with pytest.raises(Exception, match="not a URL"):
        column(spark, ["nope"], ids.canonical_url)


def test_payload_hash_keeps_nulls_but_drops_language(spark):
    parts = [F.lit("m"), F.lit(None).cast("string"), F.lit("s"), F.lit("p"), F.lit(5), F.lit('t"x'), F.lit("ts"), F.lit(None).cast("string"), F.lit(False)]
    df = spark.range(1)
    base = {
        "marketplace": "m", "native_review_id": None, "store_id": "s", "product_id": "p", "star_rating": 5,
        "comment_text": 't"x', "review_ts": "ts", "source_url": None, "has_media": False,
    }
    dump = lambda d: sha(json.dumps(d, separators=(",", ":"), ensure_ascii=False))
    row = df.select(
        ids.payload_hash(*parts, F.lit(None).cast("string")), ids.payload_hash(*parts, F.lit("en"))
    ).first()
    assert row[0] == dump(base) and row[1] == dump({**base, "language_hint": "en"})


def test_product_paths(spark):
    urls = ["/s/a/p/c", "/s/a//p/c", "/s//s/b/x/p/c", "/s/a/x/p//p/d", "/s/a/x/p", "/s/a/x/p/c/p/d", "s/a/x/p/c", "https://x.com/s/a/x/p/c#p", "/s/a/x/p/c?y=/p/z", "", None]
    got = column(spark, urls, ids.product_path)
    want = [None, ("a", "c"), ("b", "c"), ("a", "d"), None, ("a", "c"), None, ("a", "c"), ("a", "c"), None, None]
    assert [tuple(r) if r is not None else None for r in got] == want


def test_product_path_and_local_day(spark):
    got = column(spark, ["https://x.com/hk/s/S1/main/p/P2?q=1", "/s/a/b/p/c", "https://x.com/p/1"], ids.product_path)
    assert [tuple(g) if g else None for g in got] == [("S1", "P2"), ("a", "c"), None]
    days = column(spark, ["2024-01-02", "2024-13-02"], lambda c: F.date_format(ids.local_day_to_ts(c, "+08:00"), "yyyy-MM-dd HH"))
    assert days == ["2024-01-01 16", None]


def test_regex_escape(spark):
    assert column(spark, ["a.b(c)*[d]{e}\\^$|?+"], text.regex_escape) == [r"a\.b\(c\)\*\[d\]\{e\}\\\^\$\|\?\+"]
