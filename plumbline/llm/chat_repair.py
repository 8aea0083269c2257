"""The cheapest edits that bring a conversation's turns into order, with an audit of each edit.

A repaired conversation is empty or has the role initials ``s?(ua)+``. Rows are kept (K), given another role (R) or
deleted (D), and empty turns are inserted (I). Among equally cheap audits the least in ASCII order is taken.

Method: a dynamic program over a conversation's rows, with the state reached by the edits so far (nothing yet, after
system, after user, after assistant). Every state holds one audit, a linked node that shares its prefix with all audits
that grew from it. A node has one piece, the inserts before a row and what became of the row, and keeps a rolling hash
of its whole prefix and a jump to an ancestor (binary lifting in its skew form, one pointer a node, so ancestors at any
depth are a logarithmic number of steps away). Where two audits cost the same, the longest common prefix is searched by
comparing the hashes of ancestors of equal depth, and the first pieces that differ decide. Equal hashes are not trusted:
unless both ancestors are one node their pieces are compared. Neither of two equally dear audits that reach one row can
be a prefix of the other, as what the longer one adds has a cost.

A conversation is read in order, so its rows pass one task; of these rows the task sees role initials and faults, not
texts, and keeps a few nodes. Repeats are found by digest beforehand, and texts are joined to the edits by conversation
and digest, so the texts of one conversation spread over tasks. The audit and the digest of a conversation are single
values and the only places where a conversation comes together.

Defined results: rows are taken by ``turn``, nulls first, ties by role and by the digest of role and text; null roles and
texts are one space; rows without ``conv_id`` are one conversation; an empty table gives no rows; extra columns are
ignored. A row's first fault counts: ``blank``, ``duplicate`` (role and text stood earlier), ``truncated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.common import BATCH_ROWS, kept

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: State after the next of the alternating turns.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (NOTHING, ASSISTANT)

_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


class Node:
    """An audit: a prefix shared with other audits, and one more piece."""

    __slots__ = ("parent", "jump", "depth", "piece", "state", "hash")

    def __init__(self, parent: Node | None, piece: str, state: int):
        self.parent, self.piece, self.state = parent, piece, state
        if parent is None:
            self.jump, self.depth, self.hash = self, 0, 0
            return
        self.depth = parent.depth + 1
        far = parent.jump
        self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent
        value = parent.hash
        for letter in piece:
            value = (value * _BASE + ord(letter)) % _MODULUS
        self.hash = value


def same(x: Node, y: Node) -> bool:
    """Whether two audits of equal depth are the same text; equal hashes are verified."""
    if x is y:
        return True
    if x.hash != y.hash:
        return False
    while x is not y:
        if x.piece != y.piece:
            return False
        x, y = x.parent, y.parent
    return True


def before(x: Node, y: Node) -> bool:
    """Whether audit ``x`` sorts before ``y``, another one of equal depth: their first different pieces decide.

    A piece ends with the one letter that is no insert, so no piece starts another one.
    """
    while not same(x.parent, y.parent):
        x, y = (x.parent, y.parent) if same(x.jump, y.jump) else (x.jump, y.jump)
    return x.piece < y.piece


def _moves(initial: str, gone: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(state, state after, cost, piece) of all that can become of a row; the best of those that do the same."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start, inserts in product(range(4), range(3)):
        at = start
        for _ in range(inserts):
            at = NEXT[at]
        options = [("D", at, DELETE)]
        if not gone:
            stays = STAYS_TRUNCATED * truncated
            options.append(("R", NEXT[at], REROLE + stays))
            if initial == "s" and at == NOTHING:
                options.append(("K", SYSTEM, KEEP + stays))
            elif initial == {USER: "u", ASSISTANT: "a"}[NEXT[at]]:
                options.append(("K", NEXT[at], KEEP + stays))
        for letter, after, cost in options:
            found = (cost + INSERT * inserts, "I" * inserts + letter)
            best[start, after] = min(best.get((start, after), found), found)
    return [(start, after, cost, piece) for (start, after), (cost, piece) in best.items()]


#: By role initial, whether the row must go, and whether it is truncated.
MOVES = {key: _moves(*key) for key in product(("s", "u", "a", ""), (False, True), (False, True))}


class Audit:
    """The cheapest audits of the rows seen so far, one for each state."""

    def __init__(self):
        self.best: dict[int, tuple[int, Node]] = {NOTHING: (0, Node(None, "", NOTHING))}

    def add(self, initial: str, fault: str | None) -> None:
        key = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        found: dict[int, tuple[int, Node, str]] = {}
        for start, after, cost, piece in MOVES[key]:
            if start not in self.best:
                continue
            spent, node = self.best[start]
            cost += spent
            held = found.get(after)
            if held is None or cost < held[0]:
                found[after] = (cost, node, piece)
            elif cost == held[0] and (piece < held[2] if node is held[1] else before(node, held[1])):
                found[after] = (cost, node, piece)
        self.best = {after: (cost, Node(node, piece, after)) for after, (cost, node, piece) in found.items()}

    def finish(self) -> tuple[int, list[tuple[str, int]]]:
        """Cost, and (piece, state after it) by row; the last entry are inserts behind the last row."""
        ends = []
        for state, (cost, node) in self.best.items():
            closing = 0
            while state not in ENDS:
                state, closing = NEXT[state], closing + 1
            ends.append((cost + INSERT * closing, node, "I" * closing, state))
        least = ends[0]
        for end in ends[1:]:
            if end[0] < least[0] or (end[0] == least[0] and before(end[1], least[1])):
                least = end
        cost, node, closing, state = least
        out = [(closing, state)]
        while node.parent is not None:
            out.append((node.piece, node.state))
            node = node.parent
        return cost, out[::-1]


def edits_of(start: int, piece: str, after: int) -> list[tuple[str, int]]:
    """(letter, state after it) of one piece that leads from ``start`` to ``after``."""
    out, at = [], start
    for letter in piece:
        at = NEXT[at] if letter == "I" else after
        out.append((letter, at))
    return out


# -- rows ----------------------------------------------------------------------


def _filled(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    slim = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return slim.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """One slim row per row: conv_id, place (from 1), turn, new_turn, role, digest, fault, illegal (after the row before)."""
    filled = _filled(rows)
    blank, open_end = ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")
    slim = filled.select("conv_id", "turn", "role", "digest", blank.alias("blank"), open_end.alias("open_end"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    pair = F.concat(F.substring(F.lag("role").over(order), 1, 1), F.substring("role", 1, 1))
    new_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order))
    placed = slim.withColumns({"place": F.row_number().over(order), "pair": pair, "new_turn": new_turn})
    again = F.row_number().over(W.partitionBy("conv_id", "digest").orderBy("place")) > 1
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("open_end"), "truncated")
    illegal = F.coalesce(~F.col("pair").isin("su", "ua", "au"), F.lit(False))
    return placed.select("conv_id", "place", "turn", "new_turn", "role", "digest", fault.alias("fault"), illegal.alias("illegal"))


def edits(faulty: DataFrame) -> DataFrame:
    """The cheapest edits: conv_id, step (from 1), edit, role (of a turn that stays or comes in), digest (of its row), cost.

    Costs of a conversation's edits add up to the cost of its repair.
    """
    rows = faulty.select("conv_id", "place", "digest", F.substring("role", 1, 1).alias("initial"), "role", "fault")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    key = faulty.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, seen = None, None, []

        def close() -> Iterator[pa.RecordBatch]:
            _, pieces = audit.finish()
            out, step, at = [], 0, NOTHING
            for i, (piece, after) in enumerate(pieces):
                digest, role, fault = seen[i] if i < len(seen) else (None, None, None)
                for letter, state in edits_of(at, piece, after):
                    step += 1
                    stays = STAYS_TRUNCATED * (fault == "truncated" and letter in "KR")
                    cost = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter] + stays
                    held = digest if letter in "KR" else None
                    out.append((step, letter, role if letter == "K" else NAMES[state] if letter in "RI" else None, held, cost))
                at = after
                if len(out) >= BATCH_ROWS:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

        def batch(out: list) -> pa.RecordBatch:
            step, letter, role, digest, cost = zip(*out)
            columns = [pa.array([conv] * len(out), kind), pa.array(step, pa.int64()), pa.array(letter), pa.array(role, pa.string()), pa.array(digest, pa.binary()), pa.array(cost, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "step", "edit", "role", "digest", "cost"])

        kind = pa.null()
        for rows_ in batches:
            kind = rows_.column(0).type
            names = ("conv_id", "digest", "initial", "role", "fault")
            for own, digest, initial, role, fault in zip(*(rows_.column(n).to_pylist() for n in names)):
                if audit is None or own != conv:
                    if audit is not None:
                        yield from close()
                    conv, audit, seen = own, Audit(), []
                audit.add(initial, fault)
                seen.append((digest, role, fault))
        if audit is not None:
            yield from close()

    return rows.mapInArrow(run, f"conv_id {key}, step long, edit string, role string, digest binary, cost long")


def repaired(rows: DataFrame, made: DataFrame) -> DataFrame:
    """Turns after the edits ``made``: conv_id, step, edit, role, text; inserted turns have an empty text."""
    texts = _filled(rows).groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("own")).agg(F.first("text").alias("text"))
    stay = made.filter(F.col("edit").isin("K", "R"))
    held = stay.join(texts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("own")))
    new = made.filter("edit = 'I'").withColumn("text", F.lit(""))
    columns = ["conv_id", "step", "edit", "role", "text"]
    return held.select(*columns).unionByName(new.select(*columns))


@dataclass(frozen=True)
class Repair:
    faults: DataFrame
    edits: DataFrame
    turns: DataFrame


def repair(rows: DataFrame) -> Repair:
    """Faults by row, edits by step and repaired turns of all conversations of ``rows`` (conv_id, turn, role, text)."""
    faulty = kept(faults(rows), "faults")
    made = kept(edits(faulty), "edits")
    return Repair(faulty, made, repaired(rows, made))


# -- digests -------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with every fifth or so damaged, chosen by the checksum of conversation and turn; nulls are one space."""
    space = F.lit(" ")
    filled = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", None, "turn")))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    hit = filled.withColumn("kind", F.crc32(F.encode(name, "UTF-8")) % 20).filter("kind <> 0")
    return hit.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def line_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of each conversation, read in order and never held together."""
    lines = turns.select("conv_id", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "step")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            ids, out = [], []
            for own, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if state is None or own != conv:
                    if state is not None:
                        ids.append(conv)
                        out.append(state.hexdigest())
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            kind = batch.column("conv_id").type
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(out, pa.string())], ["conv_id", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], ["conv_id", "sha256"])

    return lines.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, sha256 string")


def digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id): fault counts, audit, cost and digest after repair of ``rows``."""
    done = repair(rows)
    n = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).cast("long").alias("gaps")
    counts = done.faults.groupBy("conv_id").agg(gaps, n("blank"), n("duplicate"), n("truncated"), F.count_if("illegal").alias("illegal"))
    letters = F.array_sort(F.collect_list(F.struct("step", "edit")))
    audits = done.edits.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.array_join(letters["edit"], "").alias("audit"))
    out = conversations.select("conv_id").distinct()
    for part in (counts, audits, line_digests(done.turns)):
        part = part.withColumnRenamed("conv_id", "of")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = hashlib.sha256().hexdigest()
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"))
