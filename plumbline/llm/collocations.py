"""Phrases whose words stand together more often than their parts would suggest.

The corpus becomes a weighted de Bruijn graph per language. Every word of a piece of text emits one record: the run of
``longest`` words that starts there, or what is left of the piece. Full runs are edges from the node of their first
``longest - 1`` words to that of their last; shorter records are piece ends. One aggregation of these records, combined
before its shuffle and dealt by node, is all that is counted over the corpus. Everything shorter is derived from it: a phrase starts once
in every record that begins with it, so its count is the flow out of its node plus the pieces that end with it.

Unary paths are compacted. A node is unary if a single edge enters and a single edge leaves it and both carry its whole
flow, so no piece starts or ends there either; all edges of a path of such nodes have one weight. Paths are found by
pointer doubling over edges of ``least`` or more occurrences. One node in ``STRETCH``, chosen by hash, cuts its path, so
a path fits a row and a few rounds suffice however long a copied passage is. Full-length candidates are read off the
compacted paths. Unary nodes lie inside a longer phrase that occurs as often, so none of them is a candidate.

Defined results: ``text`` null is empty, ``lang`` null is ``und``; A-Z are lower-cased; pieces end at ``.,;:!?`` and at
line breaks, words at spaces and tabs. Repeated rows count each time, ``doc_id`` is not used, extra columns are ignored.
An empty table has no phrases. Counts are exact, as are scores: products are decimals of 38 digits, which counts up to
10^16 cannot exceed. Longer candidates are counted like all others; a phrase inside a longer one needs to be compared
with those one word longer only, as what lies between occurs at least as often as the longer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.common import kept, slices

LONGEST = 3
LEAST = 10
#: Percent of a phrase's occurrences inside one longer phrase from which it is left out.
INSIDE = 50
TOP = 2000
STRETCH = 64
#: Parts in which one language's phrases are ranked before their best are ranked together.
PARTS = 64

#: Text bytes cut into words at a time, and words whose runs are counted together before they are shuffled.
SLICE_BYTES, WINDOW_WORDS, GATHER_WORDS = 2 << 20, 1 << 20, 1 << 17

#: A-Z to a-z, a tab to a space, the ends of pieces to line feeds. No byte of a longer character is concerned.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9] = 32
_FOLD[[ord(c) for c in ".,;:!?\x0b\x0c\r"]] = 10


def _first(phrase: Column | str, n: int | Column) -> Column:
    return F.call_function("substring_index", F.col(phrase) if isinstance(phrase, str) else phrase, F.lit(" "), n if isinstance(n, Column) else F.lit(n))


def _rest(phrase: Column | str, n: int, words: int) -> Column:
    """``phrase`` of ``words`` words without its first ``n``."""
    return F.substring_index(phrase, " ", n - words)


def _words(phrase: Column | str) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def _runs(texts: pa.Array, longest: int) -> tuple[np.ndarray, list[pa.Array]]:
    """Row of each word of ``texts``, and the run of up to ``longest`` words of its piece that starts with it."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.int64), []
    data = _FOLD[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    # One space between words, so that a run is one stretch of bytes.
    space = data == 32
    spare = np.flatnonzero(space[1:] & space[:-1]) + 1
    offsets = offsets - np.searchsorted(spare, offsets)
    data = np.delete(data, spare)
    solid = (data != 32) & (data != 10)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges], last[edges - 1] = solid[edges], solid[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(data == 10), starts) + row
    final = np.append(np.flatnonzero(np.diff(piece)), len(starts) - 1)
    stop = np.minimum(np.arange(len(starts)) + longest - 1, np.repeat(final, np.diff(final, prepend=-1)))
    out = []
    for i in range(0, len(starts), GATHER_WORDS):
        begin = starts[i : i + GATHER_WORDS]
        size = ends[stop[i : i + GATHER_WORDS]] - begin
        place = np.concatenate([[0], np.cumsum(size)])
        bytes_ = data[np.arange(place[-1]) + np.repeat(begin - place[:-1], size)]
        out.append(pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(place.astype(np.int64)), pa.py_buffer(bytes_)))
    return row, out


def _count_runs(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """(entry, n): runs followed by a tab and their language, counted over ``WINDOW_WORDS`` words at a time."""
    held, words = [], 0

    def counted() -> Iterator[pa.RecordBatch]:
        table = pa.table({"entry": pa.chunked_array(held, pa.large_string())}).group_by("entry").aggregate([([], "count_all")])
        columns = table["entry"].cast(pa.string()), table["count_all"].cast(pa.int32())
        yield from pa.table(columns, names=["entry", "n"]).to_batches(max_chunksize=1 << 16)

    for batch in batches:
        for begin, end in slices(batch.column("text"), SLICE_BYTES):
            part = batch.slice(begin, end - begin)
            row, runs = _runs(part.column("text"), longest)
            lang = part.column("lang").cast(pa.large_string())
            for i, some in enumerate(runs):
                held.append(pc.binary_join_element_wise(some, lang.take(pa.array(row[i * GATHER_WORDS :][: len(some)])), pa.scalar("\t", pa.large_string())))
                words += len(some)
                if words >= WINDOW_WORDS:
                    yield from counted()
                    held, words = [], 0
    if words:
        yield from counted()


def records(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, run, n): how often each run of ``longest`` words occurs, and each shorter run at the end of a piece.

    Counts are combined before the one shuffle, which deals runs by their node: all that leave a node are in one task.
    """
    slim = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    counted = slim.mapInArrow(lambda batches: _count_runs(batches, longest), "entry string, n int")
    run = F.substring_index("entry", "\t", 1)
    dealt = counted.repartition(_first(run, longest - 1))
    summed = dealt.groupBy(_first(run, longest - 1).alias("node"), "entry").agg(F.sum("n").alias("n"))
    return summed.select(F.expr("substring(entry, length(substring_index(entry, '\t', 1)) + 2)").alias("lang"), "node", run.alias("run"), "n")


def phrase_counts(found: DataFrame, longest: int = LONGEST, least: int = 1) -> DataFrame:
    """(lang, words, phrase, f) of the single words, and of all phrases of up to ``longest`` words that occur ``least`` times.

    A phrase's count is the flow out of its node, to longer runs, and the pieces that end with it: the sum of all records
    that start with it. A frequent edge, and every record's share of its node's flow, are summed side by side where they
    are; as all records of a node are together there, a rare node is known to be rare before it is shuffled again.
    """
    lone = F.array(F.lit(False))
    frequent_edge = (F.col("run") != F.col("node")) & (F.col("n") >= least)
    both = found.select("lang", "node", "run", "n", F.explode(F.when(frequent_edge, F.array(F.lit(False), F.lit(True))).otherwise(lone)).alias("edge"))
    graph = both.groupBy("lang", "node", F.when(F.col("edge"), F.col("run")).alias("run")).agg(F.sum("n").alias("f"))
    upto = lambda m: F.array(*(F.lit(i) for i in range(1, m + 1)))
    held = _words("node")
    # The lengths of the phrases that start a node, the node's own length among them if it is frequent.
    lengths = F.when(F.col("run").isNotNull(), F.array(F.lit(longest))).when((held == longest - 1) & ((F.col("f") >= least) | F.lit(longest == 2)), upto(longest - 1))
    for m in range(1, longest - 2):
        lengths = lengths.when(held == m, upto(m))
    cut = graph.select("lang", "node", "run", "f", F.explode(lengths.otherwise(upto(longest - 2))).alias("words"))
    phrase = F.coalesce("run", _first("node", F.col("words")))
    summed = cut.groupBy("lang", "words", phrase.alias("phrase")).agg(F.sum("f").alias("f"))
    return summed.filter((F.col("words") == 1) | (F.col("f") >= least))


def unary_nodes(edges: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, node) of the nodes that one edge enters and one leaves, each with the node's whole flow."""

    def heaviest(node: Column) -> DataFrame:
        return edges.groupBy("lang", node.alias("node")).agg(F.max("f").alias("most"))

    out, into = heaviest(_first("phrase", longest - 1)), heaviest(_rest("phrase", 1, longest))
    flow = nodes.select("lang", F.col("phrase").alias("node"), F.col("f").alias("most"))
    return flow.join(out, ["lang", "node", "most"], "left_semi").join(into, ["lang", "node", "most"], "left_semi").select("lang", "node")


def compact(edges: DataFrame, unary: DataFrame, longest: int = LONGEST, stretch: int = STRETCH) -> DataFrame:
    """(lang, path, f, n_edges): the edges, those that follow each other through unary nodes joined to one path."""
    inner = unary.filter(F.pmod(F.xxhash64("lang", "node"), F.lit(stretch)) != 0)
    # The edge before this one, if they meet in such a node.
    before = edges.select("lang", _rest("phrase", 1, longest).alias("node"), F.col("phrase").alias("up")).join(inner, ["lang", "node"], "left_semi")
    start = edges.withColumn("node", _first("phrase", longest - 1)).join(before, ["lang", "node"], "left")
    first = F.col("up").isNull()
    paths = kept(start.select("lang", "phrase", "f", F.coalesce("up", "phrase").alias("up"), F.when(first, 0).otherwise(1).alias("steps"), first.alias("done")), "paths")
    while not paths.filter("not done").isEmpty():
        # Each edge goes on from the edge it points to; it is done when that is the first of its path.
        behind = paths.select("lang", F.col("phrase").alias("up"), F.col("up").alias("far"), F.col("steps").alias("further"))
        moved = paths.filter("not done").join(behind, ["lang", "up"])
        moved = moved.select("lang", "phrase", "f", F.col("far").alias("up"), (F.col("steps") + F.col("further")).alias("steps"), (F.col("further") == 0).alias("done"))
        paths = kept(paths.filter("done").unionByName(moved), "paths")
    links = F.array_sort(F.collect_list(F.struct("steps", _rest("phrase", longest - 1, longest).alias("word"))))
    whole = paths.groupBy("lang", "up").agg(F.max("f").alias("f"), links.alias("links"))
    later = F.slice(F.col("links.word"), F.lit(2), F.size("links"))
    return whole.select("lang", F.array_join(F.concat(F.array("up"), later), " ").alias("path"), "f", F.size("links").alias("n_edges"))


def expand(paths: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, f) of the edges on ``paths``."""
    words = F.split("path", " ")
    windows = F.transform(F.sequence(F.lit(1), F.col("n_edges")), lambda i: F.array_join(F.slice(words, i, F.lit(longest)), " "))
    return paths.select("lang", F.explode(windows).alias("phrase"), "f")


def _not_inside(shorter: DataFrame, longer: DataFrame, words: int, inside: int) -> DataFrame:
    """Phrases of ``words`` words that no phrase one word longer holds too often."""
    ends = [longer.select("lang", part.alias("phrase"), "f") for part in (_first("phrase", words), _rest("phrase", 1, words + 1))]
    most = ends[0].union(ends[1]).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return shorter.join(most, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("most") < inside * F.col("f"), F.lit(True))).drop("most")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Score is floor(10^6 a^2 / (l r)) of the phrase's weakest cut into two parts that occur l and r times.
    """
    if longest < 2 or least < 1 or not 0 < inside <= 100:
        raise ValueError("phrases need two words, one occurrence and a share of 1 to 100 percent")
    counts = kept(phrase_counts(records(docs, longest), longest, least), "phrases")
    level = {m: counts.filter((F.col("words") == m) & (F.col("f") >= least)).drop("words") for m in range(1, longest + 1)}
    unary = kept(unary_nodes(level[longest], level[longest - 1], longest), "unary")
    paths = kept(compact(level[longest], unary, longest), "compacted")
    edges = expand(paths, longest)

    groups = [edges]
    for m in range(longest - 1, 1, -1):
        open_ = level[m] if m < longest - 1 else level[m].join(unary.withColumnRenamed("node", "phrase"), ["lang", "phrase"], "left_anti")
        groups.append(_not_inside(open_, edges if m == longest - 1 else level[m + 1], m, inside))
    cuts = [
        group.select("lang", "phrase", F.col("f").alias("a"), F.lit(k).alias("k"), _first("phrase", k).alias("left"), _rest("phrase", k, m).alias("right"))
        for m, group in zip(range(longest, 1, -1), groups)
        for k in range(1, m)
    ]
    parts = reduce(DataFrame.unionByName, [level[m] for m in range(1, longest)])
    scored = (
        reduce(DataFrame.unionByName, cuts)
        .join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", (wide("a") * wide("a")) * F.lit(1_000_000).cast("decimal(7,0)"), wide("l") * wide("r"))
    weakest = F.min(F.struct(F.col("score"), "k", "l", "r")).alias("cut")
    best = scored.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), weakest)
    slim = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = slim.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
