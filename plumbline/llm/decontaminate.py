"""Benchmark decontamination: pairs of near words find passages, Smith-Waterman alignment scores them.

Words are runs of letters and digits in lower case; in scripts without spaces each character is a word. A leak is an
alignment with ``LEAK`` of the points of a verbatim copy, but no fewer than those of ``FEWEST`` words in a row and no
more than ``LEAK_POINTS``; items of up to ``FEWEST`` words leak as whole phrases only, and ``strong`` tells whether an
alignment has more than such a phrase to show: short phrases also occur by chance. A link is a pair of words that match one after the other in both
texts, with at most one word between them in either. Links without a word between cost no points, others of one word at
most one, all further steps two or more; so an alignment of P points has links of a weight (two if adjacent in both
texts, else one) of P - 2 or more. Every passage of a document in which links reach that weight is aligned with the
item: leaks are those of an alignment of everything with everything, whatever was edited, inserted or left out.

A first pass counts the word pairs of the items in all documents. Up to half of the links that a leak could lack are not
looked for, the most common ones, and the weight that is needed is lowered by what they could add.

Test items are sent to all tasks, in slices of at most ``SLICE_WORDS`` words, one after the other; that bounds what is
broadcast and collected, not the number of items. Documents are never shuffled.

Defined results: null and empty texts and texts without links have no leaks; items that are null or
have no words are left out; items that repeat an id, or have none, are each compared, the best counts; rows with null or repeated ids are compared like any other; other columns are kept by ``annotate``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.words import ASCII_FOLD, ASCII_PUNCTUATION, mix, word_hashes

SLICE_WORDS = 1_000_000
#: Points of a matching word, another word in its place, and a word left out or put in.
MATCH, OTHER, GAP = 2, -1, -1
#: A leak has at least this share of the points of a verbatim copy of the item.
LEAK = 0.4
#: Points from which on a passage of a long item is a leak, whatever its share: those of 30 words in a row.
LEAK_POINTS = 60
#: Words in a row below which a match says little, or the whole item if that is shorter.
FEWEST = 6
#: Letters of scripts that put no spaces between words.
SPACELESS = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
#: Bytes of text hashed at a time.
TEXT_SLICE = 1 << 20
#: Links looked at together, unless one document has more.
LINKS = 1 << 20
LEAKS = "array<struct<item_id:long,score:double,start:int,end:int,strong:boolean>>"


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column, "")
    if pc.any(pc.match_substring_regex(column, SPACELESS)).as_py():
        column = pc.replace_substring_regex(column.cast(pa.large_string()), f"({SPACELESS})", r" \1 ")
    return word_hashes(pc.utf8_lower(column), ASCII_PUNCTUATION, ASCII_FOLD)


def pairs_of(words: np.ndarray, step: int) -> np.ndarray:
    """Hashes of all words with the one ``step`` further; those across rows are to be left out by the caller."""
    return mix(mix(words[: max(0, len(words) - step)]) + words[step:])


def points_of(n: int) -> int:
    """Points from which on an alignment with an item of ``n`` words is a leak."""
    return min(max(math.ceil(LEAK * MATCH * n - 1e-9), MATCH * min(n, FEWEST)), LEAK_POINTS)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: points, and where it begins and ends in ``passage``.

    A row of the table at a time: what comes from the left is a running maximum, as gaps cost the same per word.
    """
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    row, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, OTHER)
        above = row[1:] + GAP
        value = np.maximum(np.maximum(diagonal, above), 0)
        source = np.where(value == 0, np.arange(1, n + 1), np.where(diagonal >= above, begin[:-1], begin[1:]))
        value, source = np.concatenate([[0], value]), np.concatenate([[0], source])
        lifted = value + steps
        top = np.maximum.accumulate(lifted)
        came = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row, begin = top - steps, source[came]
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), int(begin[at]), at)
    return best


class Items:
    """One slice of the test items as arrays."""

    def __init__(self, ids: list[int], texts: list[str]):
        counts, words = words_of(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        whole = [(i, words[e - c : e]) for i, c, e in zip(ids, counts.tolist(), ends.tolist(), strict=True) if c]
        self.ids, self.words = [i for i, _ in whole], [w for _, w in whole]
        #: Words further of what is looked up; 0, a word by itself, only for items of one word.
        self.steps = (0, 1, 2) if any(len(w) == 1 for w in self.words) else (1, 2)
        self.all_pairs = np.unique(np.concatenate([*(pairs_of(w, step) for w in self.words for step in (1, 2)), np.zeros(0, np.uint64)]))

    def choose(self, counts: dict[int, int]) -> None:
        """Keep the links to be looked for: (pair, item, place, words further)."""
        pairs, rows, needed = [], [], []
        for item, words in enumerate(self.words):
            near, far = pairs_of(words, 1), pairs_of(words, 2)
            often = np.array([counts.get(int(p), 0) for p in near.view(np.int64)], np.int64)
            often[: len(far)] += np.array([counts.get(int(p), 0) for p in far.view(np.int64)], np.int64)
            weight = points_of(len(words)) - 2
            spared = max(0, (weight - 1) // 4)
            places = np.sort(np.argsort(often, kind="stable")[: len(often) - spared])
            needed.append(max(1, weight - 2 * spared))
            for step, own in ((1, near), (2, far)) if len(words) > 1 else ():
                at = places[places < len(own)]
                pairs.append(own[at])
                rows.append(np.stack([np.full(len(at), item), at, np.full(len(at), step)], axis=1))
            if len(words) == 1:
                pairs.append(pairs_of(words, 0))
                rows.append(np.array([[item, 0, 0]]))
        pairs, rows = np.concatenate(pairs), np.concatenate(rows)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.links = pairs[order], rows[order]
        self.needed = np.array(needed)
        lengths = np.array([len(w) for w in self.words])
        #: Points that a leak can lose at most, and words of a document that it can cover.
        self.loss = MATCH * lengths - np.array([points_of(n) for n in lengths.tolist()])
        self.cover = lengths + self.loss

    def places(self, words: np.ndarray, rows: np.ndarray, steps: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """(item, first word, end) of the stretches of ``words`` in which links reach the weight, sorted."""
        found = []
        for step, pairs in zip(self.steps, steps, strict=True):
            low, high = np.searchsorted(self.pairs, pairs, "left"), np.searchsorted(self.pairs, pairs, "right")
            at = np.flatnonzero((high > low) & (rows[: len(pairs)] == rows[step:]))
            often = high[at] - low[at]
            link = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often) + np.repeat(low[at], often)
            item, place, own = self.links[link].T
            found.append((np.repeat(at, often), item, place, np.where((own == 1) & (step == 1), 2, 1)))
        at, item, place, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        key = item * (len(words) + self.cover.max() + 1) + at
        order = np.argsort(key, kind="stable")
        at, item, place, weight, key = at[order], item[order], place[order], weight[order], key[order]
        total = np.concatenate([[0], np.cumsum(weight)])
        reached = total[np.searchsorted(key, key + self.cover[item], "right")] - total[np.searchsorted(key, key, "left")] >= self.needed[item]
        at, item, place = at[reached], item[reached], place[reached]
        begin = at - place - self.loss[item]
        return at, item, begin, begin + self.cover[item] + self.loss[item]

    def leaks(self, counts: np.ndarray, words: np.ndarray) -> list[list[dict]]:
        """Leaks in each of some documents, best first."""
        ends = np.cumsum(counts)
        rows = np.repeat(np.arange(len(counts)), counts)
        found: list[dict[int, dict]] = [{} for _ in range(len(counts))]
        spans: dict[tuple[int, int], list[list[int]]] = {}
        steps = tuple(pairs_of(words, step) for step in self.steps)
        for first, last in self.parts(ends, steps):
            where = slice(first, last)
            at, item, begin, end = self.places(words[where], rows[where], tuple(p[first : max(first, last - step)] for step, p in zip(self.steps, steps, strict=True)))
            for row, k, lo, hi in sorted(zip(rows[where][at].tolist(), item.tolist(), (begin + first).tolist(), (end + first).tolist(), strict=True)):
                lo, hi = max(int(ends[row] - counts[row]), lo), min(int(ends[row]), hi)
                own = spans.setdefault((row, k), [])
                if own and lo <= own[-1][1]:  # a stretch of the document per group of links
                    own[-1][1] = max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        for (row, k), own in spans.items():
            item, name, zero = self.words[k], self.ids[k], int(ends[row] - counts[row])
            for lo, hi in own:
                passage = words[lo:hi]
                if MATCH * np.isin(item, passage).sum() < points_of(len(item)):
                    continue  # even all words in order would not be enough
                points, begin, end = align(item, passage)
                score = points / (MATCH * len(item))
                if points >= points_of(len(item)) and (name not in found[row] or score > found[row][name]["score"]):
                    found[row][name] = {"item_id": name, "score": score, "start": lo - zero + begin, "end": lo - zero + end, "strong": points >= MATCH * FEWEST}
        return [sorted(x.values(), key=lambda leak: (-leak["score"], leak["item_id"] is None, leak["item_id"] or 0)) for x in found]

    def parts(self, ends: np.ndarray, steps: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int]]:
        """Words of whole documents that have about LINKS links together."""
        links = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
        for pairs in steps:
            links[: len(pairs)] += np.searchsorted(self.pairs, pairs, "right") - np.searchsorted(self.pairs, pairs, "left")
        total = np.concatenate([[0], np.cumsum(links)])
        first = last = 0
        for end in ends.tolist():
            if last > first and total[end] - total[first] > LINKS:
                yield first, last
                first = last
            last = end
        if last > first:
            yield first, last


def documents_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words per row, and all words, of slices of ``column``."""
    for begin, end in common.slices(column, TEXT_SLICE):
        yield words_of(column.slice(begin, end - begin))


def pair_counts(docs: DataFrame, pairs: np.ndarray, text_col: str) -> dict[int, int]:
    """How often each of ``pairs`` (sorted) occurs in all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pairs), np.int64)
        for batch in batches:
            for counts, words in documents_of(batch.column(0)):
                rows = np.repeat(np.arange(len(counts)), counts)
                for step in (1, 2):
                    own = pairs_of(words, step)
                    at = np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)
                    total += np.bincount(at[(pairs[at] == own) & (rows[: len(own)] == rows[step:])], minlength=len(pairs))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[seen].view(np.int64)), pa.array(total[seen])], ["pair", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(common.tidy(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most one row for each pair of one slice of items.
    return {r["pair"]: r["n"] for r in counted.collect()}


def annotate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", name: str = "leaks") -> DataFrame:
    """``docs`` with ``name``: its leaks as (item_id, score, start, end, strong), in words, best first."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    spaceless = "".join(rf"\p{{Is{x}}}" for x in re.findall(r"\w{3,}", SPACELESS))
    words = F.size(F.split("text", " ")) + F.length(F.regexp_replace("text", f"[^{spaceless}]", ""))
    size = items.agg(F.sum(words).alias("n")).first()["n"] or 0
    slices = -(-size // SLICE_WORDS)
    out = docs.withColumn(name, F.array().cast(LEAKS))
    text_at = docs.columns.index(text_col)
    for k in range(slices):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text").collect()
        part = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        if not part.ids:
            continue
        part.choose(pair_counts(docs, part.all_pairs, text_col))
        sent = docs.sparkSession.sparkContext.broadcast(part)

        def search(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                before = batch.column(batch.num_columns - 1).to_pylist()
                new = (leaks for counts, words in documents_of(batch.column(text_at).cast(pa.string())) for leaks in own.leaks(counts, words))
                found = [old + leaks for old, leaks in zip(before, new, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, batch.schema.types[-1])], batch.schema.names)

        out = out.mapInArrow(common.tidy(search), out.schema)
    return out


def leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, strong) of every leak; clean documents have no row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = annotate(slim, items).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.score", F.col("leak.start").alias("start_word"), F.col("leak.end").alias("end_word"), "leak.strong")
