"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans, checks confirm them (parts of addresses, digit counts, Luhn, mod-97) and words
nearby adjust a score. ``email``, ``ip``, ``card`` and ``phone`` are the base kinds: a proposal that passes its check
is a span whatever the words around it, which only move its score. The method adds ``iban`` (mod-97) and ``account``: a
digit run as long as a card number that fails Luhn counts where words nearby speak of an account.

The patterns are written so that a search never goes back over a long run: they are tried at the start of a run only
and take it whole, which finds the same leftmost matches. Offsets are sums of the lengths of what lies between matches
and of the matches, taken by a window over the matches of one text, so a text of a million matches takes linear time.

Defined results: null and empty texts have no spans; rows with a null or repeated ``doc_id`` are scanned like any
other, one result row each; spans of different kinds may overlap, equal spans of one kind cannot occur; offsets count
code points, end exclusive; other columns are ignored or, in ``redact``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Kinds in the order in which spans with one start are listed.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account")

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: What proposes spans. ``card`` proposes for ``account`` too.
PATTERNS = {
    # From the start of a run of local characters, or from the end of the match before, which may lie inside one.
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # A whole run of digits with single separators, of 12 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
}
#: A pattern can only match in texts that hold this.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Words that make a kind likelier when they stand nearby.
CONTEXT = {
    "email": "(?i)mail|contact|kontakt|correo|courriel|write",
    "ip": r"(?i)\bip\b|address|adresse|host|server|from",
    "card": "(?i)card|karte|carte|tarjeta|visa|master|amex|credit",
    "phone": "(?i)phone|call|tel|fon|mobile|llam|appel|ruf",
    "iban": "(?i)iban|account|konto|compte|cuenta|bank|transfer",
    "account": "(?i)account|konto|compte|cuenta|card|karte|carte|tarjeta|bank|visa|credit|payment",
}
#: Score of a confirmed proposal, and of an account number that no checksum confirms; words nearby add to it.
CONFIRMED, UNCONFIRMED, NEARBY, ENOUGH = 0.7, 0.3, 0.25, 0.5
#: Characters before and after a proposal that count as nearby.
BEFORE, AFTER = 48, 24


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn."""

    def value(i: Column) -> Column:
        x = F.substr(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces passes mod-97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", ""))
        small = lambda p: F.when(part(p) > 3, False).otherwise(F.substr(p, -F.least(F.length(p), F.lit(3))).cast("int") <= 255)
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(match, " ", ""))
    return F.lit(True)


def score(kind: str, match: Column, before: Column, after: Column) -> Column:
    """0 to 1; a proposal of ``kind`` is a span from ``ENOUGH`` on."""
    nearby = lambda k: F.when(before.rlike(CONTEXT[k]) | after.rlike(CONTEXT[k]), NEARBY).otherwise(0.0)
    if kind == "account":
        return F.when(confirmed("card", match), 0.0).otherwise(UNCONFIRMED + nearby(kind))
    return F.when(confirmed(kind, match), CONFIRMED + nearby(kind)).otherwise(0.0)


def _matches(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(text.contains(NEEDS[kind]), found) if kind in NEEDS else found


def proposals(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with, for each kind that has a pattern, its matches ``m_kind`` and what lies between them ``g_kind``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select("*", *(_matches(text, kind).alias(f"m_{kind}") for kind in PATTERNS))
    return out.select("*", *(F.when(F.size(f"m_{kind}") > 0, F.split(text, PATTERNS[kind], -1)).alias(f"g_{kind}") for kind in PATTERNS))


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array of (start, kind_no, end, kind, score)) by start and kind, one row per input row."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def rows(kind: str) -> Column:
        gaps = F.col(f"g_{kind}")
        each = F.transform(
            F.col(f"m_{kind}"),
            lambda match, i: F.struct(
                F.lit(kind).alias("pattern"),
                i.alias("i"),
                F.length(F.get(gaps, i)).alias("gap"),
                match.alias("match"),
                F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"),
            ),
        )
        return F.when(F.size(f"m_{kind}") > 0, each).otherwise(F.array().cast("array<struct<pattern:string,i:int,gap:int,match:string,before:string,after:string>>"))

    each = proposals(slim, "text").select("row", "doc_id", F.explode_outer(F.concat(*(rows(kind) for kind in PATTERNS))).alias("p"))
    each = each.select("row", "doc_id", "p.*")
    so_far = W.partitionBy("row", "pattern").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(so_far)).withColumn("start", F.col("end") - F.length("match"))
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    points = F.lit(0.0)
    for kind in PATTERNS:
        points = F.when(F.col("pattern") == kind, score(kind, match, before, after)).otherwise(points)
    each = each.withColumn("base", points)
    unsure = (F.col("pattern") == "card") & (F.col("base") == 0)
    each = each.withColumn("score", F.when(unsure, score("account", match, before, after)).otherwise(F.col("base")))
    kind = F.when(unsure, "account").otherwise(F.col("pattern"))
    span = F.struct(
        F.col("start"),
        (F.array_position(F.lit(list(KINDS)), kind) - 1).cast("int").alias("kind_no"),
        F.col("end"),
        kind.alias("kind"),
        F.round("score", 2).alias("score"),
    )
    found = F.collect_list(F.when(F.col("score") >= ENOUGH, span))
    # A group is the matches of one text, never more than its length.
    return each.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(found).alias("spans")).drop("row")


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the hash of their list, and the list of all spans."""
    found = F.col("spans")
    base = F.filter(found, lambda s: s["kind_no"] < len(BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans(docs, id_col=id_col, text_col=text_col).select(
        "doc_id",
        *map(number, BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(found).alias("spans"),
    )


def _shown(kind: str):
    """What comes before a match and what is shown in its place."""

    def piece(match: Column, i: Column) -> Column:
        gap, before, after = F.get(F.col("__g"), i), F.right(F.get(F.col("__g"), i), F.lit(BEFORE)), F.left(F.get(F.col("__g"), i + 1), F.lit(AFTER))
        shown = F.when(score(kind, match, before, after) >= ENOUGH, f"[{kind.upper()}]")
        if kind == "card":
            shown = shown.when(score("account", match, before, after) >= ENOUGH, "[ACCOUNT]")
        return F.concat(gap, shown.otherwise(match))

    return piece


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in brackets; null stays null.

    Kinds are replaced one after the other, the longest forms first, each by joining what lies between its matches.
    """
    for kind in ("email", "iban", "phone", "ip", "card"):
        text = F.col(text_col)
        out = docs.withColumn("__m", _matches(text, kind)).withColumn("__g", F.when(F.size("__m") > 0, F.split(text, PATTERNS[kind], -1)))

        joined = F.concat(F.array_join(F.transform("__m", _shown(kind)), ""), F.element_at("__g", -1))
        docs = out.withColumn(text_col, F.when(F.size("__m") > 0, joined).otherwise(text)).drop("__m", "__g")
    return docs
