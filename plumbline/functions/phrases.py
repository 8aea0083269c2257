"""Cutting canned phrases out of a text.

The definition is a case-blind alternation of all phrases, longest first: at each
position the longest phrase that matches there is cut, then the search goes on
behind it. One pass over the text finds all phrases of a block at once; the automaton
for that is built once per task. Tables of more than one block report their matches
as intervals, at most one per place and block, which are resolved per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.constants import WHITESPACE
from plumbline.functions.slices import values


INTERVALS = "array<struct<start:int,end:int>>"


def fold_char(c: str) -> str:
    upper = c.upper() if len(c.upper()) == 1 else c
    return upper.lower() if len(upper.lower()) == 1 else upper


def fold(text: str) -> str:
    """Case-blind form with one character per character of ``text``."""
    folded = text.upper().lower().replace("ς", "σ")
    return folded if len(folded) == len(text) else "".join(map(fold_char, text)).replace("ς", "σ")


def cut_phrases(text: str, found: list[tuple[int, int]]) -> str:
    """``text`` without the longest match at each position, left to right.
    ``found`` holds every match as (start, end)."""
    kept, at = [], 0
    for start, end in sorted(found, key=lambda m: (m[0], -m[1])):
        if start >= at:
            kept.append(text[at:start])
            at = end
    return "".join(kept) + text[at:]


def finder_of(phrases: list[str]) -> ahocorasick.Automaton:
    finder = ahocorasick.Automaton()
    for phrase in phrases:
        finder.add_word(phrase, len(phrase))
    finder.make_automaton()
    return finder


def left_of(text: str, found: list[tuple[int, int]]) -> int:
    return len((cut_phrases(text, found) if found else text).strip(WHITESPACE))


def stripped_length(texts: Column, phrases: list[str]) -> Column:
    """Characters left, outer white space aside, once all phrases are cut. A null
    text has no length. All phrases go to every task: for lists of bounded size."""
    folded = sorted({fold(p) for p in phrases if p})

    @F.arrow_udf("long")
    def left_over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = finder_of(folded)
        for batch in batches:
            lengths = []
            for text in values(batch):
                if text is None:
                    lengths.append(None)
                    continue
                found = [(end + 1 - size, end + 1) for end, size in finder.iter(fold(text))] if folded else []
                lengths.append(left_of(text, found))
            yield pa.array(lengths, pa.int64())

    # Declared non-deterministic so that a filter on the length is not rewritten
    # into a second call of the function below the first.
    return left_over.asNondeterministic()(texts)


def intervals(texts: Column, phrases: list[str]) -> Column:
    """The longest match of ``phrases`` at each place of a text as (start, end), in
    order; null for null texts."""
    folded = sorted({fold(p) for p in phrases if p})

    @F.arrow_udf(INTERVALS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = finder_of(folded)
        for batch in batches:
            rows = []
            for text in values(batch):
                longest: dict[int, int] = {}
                for end, size in finder.iter(fold(text)) if text is not None and folded else ():
                    longest[end + 1 - size] = max(longest.get(end + 1 - size, 0), end + 1)
                rows.append(None if text is None else [{"start": a, "end": b} for a, b in sorted(longest.items())])
            yield pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))

    return found.asNondeterministic()(texts)


def length_without(texts: Column, found: Column) -> Column:
    """Characters left of a text once the longest of ``found`` at each place are cut."""

    @F.arrow_udf("long")
    def left_over(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text_batch, found_batch in batches:
            rows = zip(values(text_batch), values(found_batch), strict=True)
            yield pa.array([None if t is None else left_of(t, [(x["start"], x["end"]) for x in hits or ()]) for t, hits in rows], pa.int64())

    return left_over.asNondeterministic()(texts, found)
