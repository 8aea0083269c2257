"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets of word shingles.

A document's set holds the hashes of its distinct shingles of five words. Documents with equal sets form a class and
are compared as one. Minhashes come in two collections of ``SIDE`` short tuples of ``DEPTH`` values each; a table key
combines a tuple of the first with one of the second, so SIDE * SIDE tables cost 2 * SIDE * DEPTH minhashes. A pair
shares a table exactly if it agrees in a tuple of either collection: that fails in one of ten thousand pairs at a
similarity of 0.75, in one of a million at 0.82. Most documents share no tuple of the first collection with any other; they are left out before keys
are made.

The members of a table are not paired with each other. Each is compared with the member that shares most tables with
others, the pivot, on full sets; links between them make components. Tables whose members then lie in different
components are joined to groups of what may still be linked. In a group, all that lies outside its largest component is
compared with all of it on full sets, block by block of bounded size; a block reports only links that join components.
So every pair that shares a table is either in one component or was compared. Tables with the same members count once.

Defined results: a text without words has an empty set and links with nothing; fewer than five words are one shingle;
rows with a null id keep a null component and stay; rows with one id and one text are one document, each keeping its
row; rows with one id and different texts each take the class of their own text. Words beyond white space are any
characters; only A to Z are folded. Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.words import mix, word_hashes

WORDS = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
SIDE, DEPTH = 18, 3
HASHES = 2 * SIDE * DEPTH
#: Shingles of a group's members in one block, unless one member has more.
BLOCK = 1 << 19
#: Parts that a group is dealt to while its totals are joined.
SALTS = 32
#: Bytes of text hashed at a time.
SLICE = 1 << 20

_random = np.random.default_rng(75)
_PLACE = _random.integers(1, 2**63, WORDS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _random.integers(1, 2**63, HASHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 2**63, HASHES, dtype=np.int64).astype(np.uint64)
_TABLE = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for begin, end in common.slices(column, SLICE):
        counts, words = word_hashes(column.slice(begin, end - begin))
        rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            rolled += words[k : k + len(rolled)] * _PLACE[k]
        rolled = mix(rolled)
        at = 0
        for n in counts.tolist():
            if n >= WORDS:
                yield np.unique(rolled[at : at + n - WORDS + 1])
            elif n:
                yield mix(np.array([(words[at : at + n] * _PLACE[:n]).sum() + np.uint64(n)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            at += n


def minhashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[at : at + 4096, None] * _FACTOR + _SHIFT).min(axis=0))
    return least


def sketches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, h1, h2, a, b): set size and hashes, tuples of both collections."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, tuples = [], [], [], []
            for shingles in shingle_sets(batch.column(1)):
                n.append(len(shingles))
                h1.append(mix(shingles).sum(dtype=np.uint64))
                h2.append(mix(shingles ^ _PLACE[0]).sum(dtype=np.uint64))
                own = minhashes(shingles)
                tuples.append(mix((mix(own) * _TABLE).reshape(2 * SIDE, DEPTH).sum(axis=1, dtype=np.uint64)).view(np.int64))
            tuples = np.array(tuples, np.int64).reshape(len(n), 2, SIDE)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(tuples[:, k]).ravel()), SIDE).cast(pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array(np.array(h, np.uint64).view(np.int64)) for h in (h1, h2)), *lists],
                ["doc_id", "n", "h1", "h2", "a", "b"],
            )

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(common.tidy(run), "doc_id long, n long, h1 long, h2 long, a array<long>, b array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rep, n, shingles) of the documents with an id in ``ids.rep``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1))]
            ends = np.cumsum([0, *map(len, sets)])
            flat = pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["rep", "n", "shingles"]
            )

    slim = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    return slim.join(ids, "rep", "left_semi").mapInArrow(common.tidy(run), "rep long, n long, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node that can be reached, for every node of ``edges`` (a, b) with a neighbour.

    Each round every node takes its smallest neighbour's name, or the name that one takes, and the links are then drawn
    between names: what is left shrinks by half or more. Each round is written, which cuts lineage.
    """
    edges = common.kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    names = edges.sparkSession.createDataFrame([], "node long, label long")
    started = False
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        near = ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))
        near = common.kept(near, "near")
        further = near.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = common.kept(near.join(further, "label").select("node", F.col("further").alias("label")), "step")
        if started:
            renamed = step.select(F.col("node").alias("label"), F.col("label").alias("newer"))
            names = common.kept(names.join(renamed, "label", "left").select("node", F.coalesce("newer", "label").alias("label")), "names")
        else:
            names, started = step, True
        for end in ("a", "b"):
            edges = edges.join(step.select(F.col("node").alias(end), F.col("label").alias(f"new_{end}")), end)
        edges = common.kept(edges.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).filter("a <> b").distinct(), "links")
    return names


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    x = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    y = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b")
    common_size = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(100 * common_size >= PERCENT * (F.col("n_a") + F.col("n_b") - common_size)).select("a", "b").distinct()


def dealt(exploded: DataFrame) -> DataFrame:
    """``exploded``, joined by a shuffle only: Spark expects no more of it than of the rows before the explode, and would broadcast it."""
    return exploded.hint("merge")


def _sized(n_a: str, n_b: str):
    """Sets whose sizes differ more can't be similar enough."""
    return (100 * F.col(n_a) >= PERCENT * F.col(n_b)) & (100 * F.col(n_b) >= PERCENT * F.col(n_a))


def link_groups(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components of ``members`` (group, rep, label, n), on the full ``sets`` (rep, shingles).

    Within a group, all members outside of its largest component meet all members, in blocks of about BLOCK shingles.
    """
    sizes = members.groupBy("group", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    totals = sizes.groupBy("group").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("s").alias("all"))
    rest = sizes.join(totals, "group").filter("label <> main").groupBy("group").agg(F.sum("s").alias("rest"))
    # A group's totals are dealt by salt, and only then the sets come in, by set.
    facts = totals.join(rest, "group").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    members = salted.join(facts, ["group", "salt"]).drop("salt").join(sets.select("rep", "shingles"), "rep")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    own = lambda c: F.pmod(F.xxhash64("rep"), blocks(c)).cast("int")
    columns = ["group", "i", "j", "side", "rep", "label", "shingles"]
    left = members.filter("label <> main").select("*", own("rest").alias("i"), F.explode(F.sequence(F.lit(0), blocks("all") - 1)).alias("j"), F.lit(0).alias("side"))
    right = members.select("*", own("all").alias("j"), F.explode(F.sequence(F.lit(0), blocks("rest") - 1)).alias("i"), F.lit(1).alias("side"))
    sides = left.select(columns).unionByName(right.select(columns)).repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side")

    def compare(rows: list[tuple[int, int, int, np.ndarray]]) -> list[tuple[int, int]]:
        lefts, rights = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
        if not lefts or not rights:
            return []
        sets = [r[3] for r in rights]
        sizes_ = np.array(list(map(len, sets)))
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes_) - sizes_
        names, at = np.unique([r[2] for r in rows], return_inverse=True)  # components seen here, joined as links turn up
        joined = np.arange(len(names))
        label_left, label_right = at[: len(lefts)], at[len(lefts) :]
        out = []
        for (_, rep, _, shingles), label in zip(lefts, label_left, strict=True):
            place = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            held = np.zeros(len(known), bool)
            held[place[known[place] == shingles]] = True
            both = np.add.reduceat(held[flat], starts, dtype=np.int64)
            for k in np.flatnonzero(100 * both >= PERCENT * (len(shingles) + sizes_ - both)).tolist():
                mine, other = joined[label], joined[label_right[k]]
                if mine != other:
                    joined[joined == other] = mine
                    out.append((rep, rights[k][1]))
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, name = [], None

        def found() -> pa.RecordBatch:
            links = compare(rows)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            names = zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True)
            ends = batch.column(6).offsets.to_numpy()
            flat = batch.column(6).values.to_numpy()
            for k, (where, *row) in enumerate(zip(names, *(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True)):
                if where != name:
                    yield found()
                    rows, name = [], where
                rows.append((*row, flat[ends[k] : ends[k + 1]].copy()))
        yield found()

    return sides.mapInArrow(common.tidy(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    own = common.kept(sketches(docs, id_col=id_col, text_col=text_col), "sketches")
    classes = own.filter("n > 0 and doc_id is not null").groupBy("n", "h1", "h2")
    classes = classes.agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("a", "b")))
    classes = common.kept(classes, "classes")

    firsts = classes.select("rep", F.explode("a").alias("ak"))
    shared = firsts.groupBy("ak").count().filter("count > 1")
    likely = firsts.join(dealt(shared), "ak", "left_semi").select("rep").distinct()
    likely = common.kept(classes.join(likely, "rep", "left_semi"), "likely")

    keys = likely.select("rep", "b", F.explode("a").alias("ak")).select("rep", "ak", F.explode("b").alias("bk")).select("rep", F.xxhash64("ak", "bk").alias("key"))
    tables = keys.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("rep")).alias("who")).filter("c > 1")
    tables = tables.groupBy("c", "who").agg(F.min("key").alias("key"))
    members = common.kept(keys.join(dealt(tables.select("key", "c")), "key"), "members")

    sets = common.kept(full_sets(docs, members.select("rep").distinct(), id_col=id_col, text_col=text_col), "sets")
    sizes = likely.select("rep", "n")
    shares = members.groupBy("rep").agg(F.sum("c").alias("shares"))
    pivots = members.join(shares, "rep").groupBy("key").agg(F.max_by("rep", "shares").alias("pivot"))
    pivots = common.kept(pivots, "pivots")
    pairs = members.join(pivots, "key").filter("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    pairs = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").filter(_sized("n_a", "n_b")).select("a", "b")
    pairs = common.kept(pairs, "pairs")
    links = common.kept(confirm(pairs, sets), "confirmed")

    labels = components(links)
    named = members.select("key", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("label", "rep").alias("label"))
    # What a key ties together are components, so its members are reduced to these before keys are looked at.
    tied = common.kept(named.distinct(), "tied")
    mixed = tied.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key", "lo")
    groups = components(tied.join(mixed, "key").select(F.col("label").alias("a"), F.col("lo").alias("b")))
    groups = groups.select(F.col("node").alias("label"), F.col("label").alias("group"))
    reps = sizes.join(labels, F.col("rep") == F.col("node"), "left").select("rep", "n", F.coalesce("label", "rep").alias("label"))
    open_ = common.kept(reps.join(groups, "label"), "open")
    more = common.kept(link_groups(open_, sets), "more")
    labels = components(links.union(more)) if not more.isEmpty() else labels

    groups = classes.select("n", "h1", "h2", "rep").join(labels, F.col("rep") == F.col("node"), "left")
    groups = groups.select(F.col("n").alias("n_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), F.coalesce("label", "rep").alias("group"))
    slim = own.select("doc_id", "n", "h1", "h2")
    joined = slim.join(groups, (F.col("n") == F.col("n_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
