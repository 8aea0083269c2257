"""Review text as column expressions: clean-up, lengths, language, regex helpers."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plumbline.constants import LANGUAGE_HINTS, WHITESPACE, YUE_PARTICLES

_SPACE_RUN = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"

# Strings made only of these characters are already in Unicode form C: nothing
# below U+0300 composes or decomposes, nor do Han ideographs of the main block,
# common CJK stops, full-width ASCII and general punctuation.
_FORM_C_ONLY = (
    "^[\\x{0}-\\x{2ff}\\x{2010}-\\x{2027}\\x{2030}-\\x{205e}"
    "\\x{3001}-\\x{3003}\\x{4e00}-\\x{9fff}\\x{ff01}-\\x{ff5e}]*$"
)


@F.arrow_udf(StringType())
def _to_form_c(texts: pa.Array) -> pa.Array:
    # Not pyarrow.compute.utf8_normalize: its "NFC" decomposes.
    fixed = [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()]
    return pa.array(fixed, pa.string())


def form_c(text: Column) -> Column:
    """Unicode form C. Only strings that may change travel to Python; the rest
    are sent as NULL, which costs one validity bit."""
    text = text.cast("string")
    return F.coalesce(_to_form_c(F.when(~text.rlike(_FORM_C_ONLY), text)), text)


def collapse_spaces(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, _SPACE_RUN, " "))


def normalize_text(text: Column) -> Column:
    return collapse_spaces(form_c(text))


def trim_spaces(text: Column) -> Column:
    """Trim every Unicode blank, which plain ``trim`` does not."""
    return F.btrim(text, F.lit(WHITESPACE))


def content_hash(text: Column) -> Column:
    return F.sha2(normalize_text(text), 256)


def code_points(text: Column) -> Column:
    return F.char_length(text).cast("long")


def utf16_units(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def cut_utf16(text: Column, units: int) -> Column:
    """First ``units`` UTF-16 units, never half a surrogate pair."""
    wide = F.encode(text, "UTF-16BE")
    last_unit = F.hex(F.substring(wide, 2 * units - 1, 2))
    keep = F.when(last_unit.between("D800", "DBFF"), 2 * units - 2).otherwise(2 * units)
    cut = F.decode(F.substring(wide, F.lit(1), keep), "UTF-16BE")
    return F.when(utf16_units(text) > units, cut).otherwise(text)


def cap_text(text: Column, chars: int) -> Column:
    """Prefix for remote models with a fixed input window. Nothing else uses it."""
    return F.left(text, F.lit(chars))


def language_hint(text: Column, given: Column | None = None) -> Column:
    has_han = text.rlike("\\p{IsHan}")
    has_latin = text.rlike("[A-Za-z]")
    inferred = (
        F.when(text.rlike(f"[{YUE_PARTICLES}]"), "yue")
        .when(has_han & has_latin, "mixed")
        .when(has_han, "zh-Hant")
        .when(has_latin, "en")
        .otherwise("unknown")
    )
    return inferred if given is None else F.coalesce(given, inferred)


def is_language(tag: Column) -> Column:
    return tag.isin(LANGUAGE_HINTS)


def regex_escape(text: Column) -> Column:
    return F.regexp_replace(text, "([\\\\.^$|?*+()\\[\\]{}])", "\\\\$1")


def stripped_length(text: Column, pattern: Column) -> Column:
    """Length of what is left once ``pattern`` is cut out. A NULL pattern cuts nothing."""
    cut = F.when(pattern.isNull(), text).otherwise(
        F.regexp_replace(text, F.coalesce(pattern, F.lit("$^")), F.lit(""))
    )
    return code_points(trim_spaces(cut))


def strict_json(line: Column) -> Column:
    """One JSON value as VARIANT, NULL when ``line`` is anything else. The parser
    stops at the end of the first value, so the line is parsed inside a frame in
    which trailing characters are an error or a second element."""
    framed = F.try_parse_json(F.concat(F.lit('[{"v":['), line, F.lit("]}]")))
    alone = F.variant_get(framed, "$[1]", "variant").isNull() & F.variant_get(framed, "$[0].v[1]", "variant").isNull()
    return F.when(alone, F.variant_get(framed, "$[0].v[0]", "variant"))
