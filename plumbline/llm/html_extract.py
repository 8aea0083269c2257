"""Main text of web pages as the best-scoring run of blocks: words count for a block, tags against it.

A page is read once, as tags and text. Text belongs to blocks; elements that never hold an article (menus, headers,
footers, forms, scripts, comment threads and what names itself an advert, notice or sidebar) are left out with all they
hold. A name is not believed if its element holds a heading of the first level and most of the words that lie
in such elements or outside of all that have such names: that is a wrapper around the article (``with-sidebar``, ``no-comments``). Each block scores its words, less what their surroundings and the tags around it cost, and one pass finds the
run of blocks with the largest sum. Costs are learned from labelled pages, those that mark their article themselves:
how often words under an element, a class or an id lie inside the article. ``SAMPLE`` pages are used at most, those
with the smallest hashes; extraction covers every page.

Defined results: null and empty html, and pages without a block of positive score, have the empty text; a script, style
or comment that never ends reaches to the end of the page; ``article`` and ``main`` end whatever was left open before
them; rows with null or repeated ids are read like any other; without labelled pages the costs are ``PRIOR``; other
columns are ignored, also if they are named like results.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common

SAMPLE = 5_000
#: Learned weights at most, words a weight needs, and how strong it can be.
WEIGHTS, SUPPORT, STRONGEST = 2_000, 50, 4.0
#: Words that every element is taken to have on either side.
SMOOTH = 10
#: What a tag costs its block.
TAG_COST = 0.05
#: Weights without labelled pages.
PRIOR = {"a": -2.0, "li": -1.0, "outside": -4.0}

RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav header footer aside form button select option menu dialog svg math object canvas audio video map applet".split())
MAIN = frozenset(("article", "main"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr td th nobr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words in class and id names of what is no article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager header masthead footer comment comments commentlist reply replies respond disqus discussion widget toolbar search "
    "copyright legal disclaimer skip".split()
)
_TOKEN = re.compile(
    r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>?", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLOSED_BY = {"p": frozenset(("p",)), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "option": frozenset(("option",))}


class Block:
    __slots__ = ("parts", "tags", "inside")

    def __init__(self):
        #: Text as it stands, what is open around it, and numbers of the open elements whose names speak against it.
        self.parts: list[tuple[str, tuple[str, ...], tuple[int, ...]]] = []
        self.tags, self.inside = 0, False

    def text(self) -> str:
        return " ".join(entities.unescape("".join(part[0] for part in self.parts)).split())


def _attributes(source: str) -> tuple[list[str], bool, bool]:
    """Class and id names, whether the role says that the element holds no article, and whether a name does."""
    names, never, named = [], False, False
    for name, *values in _ATTRIBUTE.findall(source):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            never |= value in ROLES
        else:
            names += value.split()
            named |= not NAMES.isdisjoint(re.split(r"[\s_-]+", value))
    return names, never, named


def _believed(found: list[Block], titled: set[int]) -> list[Block]:
    """``found`` without what lies in elements whose names speak against it, but for wrappers of the article."""
    total, within = 0, dict.fromkeys(titled, 0)
    for block in found:
        for text, _, marks in block.parts:
            n = len(text.split())
            over = titled.intersection(marks)
            total += n if over or not marks else 0
            for mark in over:
                within[mark] += n
    wrappers = {mark for mark, n in within.items() if 2 * n > total}
    for block in found:
        block.parts = [part for part in block.parts if wrappers.issuperset(part[2])]
    return [b for b in found if b.text()]


def blocks(page: str) -> tuple[list[Block], bool]:
    """Blocks with text, in page order, outside of what never holds an article; whether the page marks its article."""
    out, block, at, marked = [], Block(), 0, False
    stack: list[tuple[str, tuple[str, ...], bool, int]] = []  # element, names for weights, left out, number if its name speaks against it
    marks, titled = 0, set()

    def open_marks() -> tuple[int, ...]:
        return tuple(entry[3] for entry in stack if entry[3])

    def flush() -> None:
        nonlocal block
        if block.parts:
            out.append(block)
            block = Block()

    def text(until: int) -> None:
        if until > at and not (stack and stack[-1][2]):
            here = tuple(key for entry in stack for key in entry[1])
            block.parts.append((page[at:until], here, open_marks()))
            block.inside |= any(entry[0] in MAIN for entry in stack)

    last = page.rfind(">")
    while True:
        token = _TOKEN.search(page, at) if at <= last else None
        if token is None:
            text(len(page))
            flush()
            return _believed(out, titled), marked
        text(token.start())
        at = token.end()
        if token[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        closing, name, rest = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        name = name.lower()
        out_of_sight = bool(stack) and stack[-1][2]
        if name == "br" or name in ("td", "th"):
            if not out_of_sight and block.parts:
                block.parts.append((" ", (), open_marks()))
        elif name not in INLINE and not out_of_sight:
            flush()
        if not out_of_sight:
            block.tags += 1
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            if name not in INLINE:
                flush()
            continue
        if name in RAW:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = len(page) if end is None else end.end()
            continue
        if name in VOID:
            continue
        if name in MAIN:
            marked = True
            while stack and stack[-1][0] not in MAIN and stack[-1][0] != "body":
                stack.pop()
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in _CLOSED_BY.get(name, ()):
                del stack[depth:]
                break
            if stack[depth][0] not in INLINE:
                break
        names, never, named = _attributes(rest)
        if name in ("html", "body") or name in MAIN:
            stack.append((name, (), False, 0))
        else:
            if name == "h1" and not out_of_sight:
                titled.update(open_marks())
            left_out = never or name in NEVER or named and name in INLINE or bool(stack) and stack[-1][2]
            marks += named
            stack.append((name, tuple(f".{n}" for n in names) or (name,), left_out, marks if named else 0))
        if rest.rstrip().endswith("/") and name not in INLINE and stack:
            stack.pop()


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest positive sum, the longest of the first ones; (0, 0) without any."""
    best, found, total, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, begin = 0.0, i
        total += score
        if total > best or total == best and found[1] and begin == found[0]:
            best, found = total, (begin, i + 1)
    return found


def block_score(block: Block, marked: bool, weights: dict[str, float]) -> float:
    total = -TAG_COST * block.tags
    for text, keys, _ in block.parts:
        n = len(text.split())
        worst = min((weights.get(key, 0.0) for key in keys), default=0.0)
        if marked and not block.inside:
            worst = min(worst, weights.get("outside", 0.0))
        total += n * max(-1.0, min(1.0, 1.0 + worst / 2))
    return total


def main_text(page: str, weights: dict[str, float]) -> str:
    found, marked = blocks(page)
    begin, end = best_run([block_score(b, marked, weights) for b in found])
    return "\n".join(b.text() for b in found[begin:end])


def learn_weights(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weight of each element, class and id: log odds that words under it lie in the article of pages that mark one."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[int]] = {}
        for batch in batches:
            for page in common.texts(batch.column(0)):
                found, marked = blocks(page)
                for block in found if marked else ():
                    for text, keys, _ in block.parts:
                        n = len(text.split())
                        for key in {*keys, *(() if block.inside else ("outside",))}:
                            totals.setdefault(key, [0, 0])[0 if block.inside else 1] += n
        keys = list(totals)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([totals[k][i] for k in keys], pa.int64()) for i in (0, 1))], ["key", "inside", "outside"])

    # At most ``sample`` ids, which is what is sent to every task.
    chosen = pages.select(F.col(id_col).alias("__id")).filter("__id is not null").orderBy(F.xxhash64("__id"), "__id").limit(sample).distinct()
    rows = pages.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"), "left_semi").select(F.col(html_col).cast("string").alias("html"))
    counts = rows.mapInArrow(count, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    most = counts.orderBy(F.desc(F.col("inside") + F.col("outside")), "key").limit(WEIGHTS).collect()
    learned = {r["key"]: math.log((r["inside"] + SMOOTH) / (r["outside"] + SMOOTH)) for r in most if r["inside"] + r["outside"] >= SUPPORT}
    return {**PRIOR, **{k: max(-STRONGEST, min(STRONGEST, w)) for k, w in learned.items() if k != "outside"}}


def extract(pages: DataFrame, weights: dict[str, float], *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page, weights) for page in common.texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return slim.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
