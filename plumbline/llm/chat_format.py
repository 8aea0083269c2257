"""Conversations as training text, with DataFrame functions only.

A declarative template names, for each role, the markers around a turn, whether its text is learned from and which
roles may come next. It is run as a finite-state machine: a state is the role read last, so the machine's state before
a turn is one ``lag`` away and no turn waits for a whole conversation to be gathered. Each turn emits segments, the
marker before it, its text and the marker after it, each with a loss flag. Joined in order they are the formatted text.

Control strings inside texts are escaped reversibly: behind the first character of each, however often it is escaped
already, one more backslash is put. No control string starts inside another one, so escaped texts hold none, and
``read_turns`` finds turns again by their markers alone.

Defined results: turns are taken by ``turn``, nulls first, ties by role and text; repeated rows are turns of their own.
A null text or role is empty. A role the template does not name keeps its name between markers of its own. Turns out of
order are formatted like others and counted as faults. Rows without ``conv_id`` are one conversation. An empty table
gives no rows; other columns are ignored. ``format_turns`` holds one turn at a time. ``format_conversations`` makes one
row of a conversation, and so must anything that digests it whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: State before the first turn, and state behind a role the template does not name.
START, OTHER = "start", "other"


@dataclass(frozen=True)
class Turn:
    """Markers of one role's turns, and whether their text is learned from."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]"),
            "user": Turn("[INST]", "[/INST]"),
            "assistant": Turn("[ANSWER]", "</s>", loss=True),
        }
    )
    #: Turns of other roles: ``before`` role ``between`` text ``after``.
    other: Turn = Turn("[TURN]", "[/TURN]")
    between: str = "[SAYS]"
    #: Which roles may follow each state, and where a conversation may end.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = self.controls()
        if any(not m or m[0] == "\\" or m[1:2] == "\\" or len(m) < 2 for m in marks) or len(set(marks)) < len(marks):
            raise ValueError("markers need two characters or more, differ, and do not start with a backslash")
        if any(mark.find(first[0], 1) > 0 or (mark != first and mark.startswith(first)) for mark in marks for first in marks):
            raise ValueError("no marker may start another one or hold the first character of one further on")
        if {START, OTHER} & set(self.turns):
            raise ValueError(f"{START} and {OTHER} are states, not roles")

    def controls(self) -> list[str]:
        each = [m for t in (*self.turns.values(), self.other) for m in (t.before, t.after)]
        return [self.begin, self.between, *each]


TEMPLATE = Template()


def _tails(template: Template) -> str:
    """Pattern of a control string: first character, backslashes, rest."""
    by_first: dict[str, list[str]] = {}
    for mark in template.controls():
        by_first.setdefault(mark[0], []).append(mark[1:])
    kinds = [f"(?:{re.escape(c)}(?=\\\\*(?:{'|'.join(map(re.escape, rests))})))" for c, rests in by_first.items()]
    return "|".join(kinds)


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """``text`` without control strings."""
    return F.regexp_replace(text, f"({_tails(template)})", r"$1\\")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"({_tails(template)})\\", "$1")


def _by_role(role: Column, template: Template, value, otherwise) -> Column:
    """``value(turn)`` of the role's entry in the template."""
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for name, turn in template.turns.items():
        out = F.when(role == name, F.lit(value(turn))).otherwise(out)
    return out


def format_turns(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, position (from 1), role, state before it, legal, last, segments (text, loss)."""
    empty = F.lit("")
    slim = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    role = F.col("role")
    reached = F.when(role.isin(*template.turns), role).otherwise(OTHER)
    state = F.coalesce(F.lag(reached).over(order), F.lit(START))
    placed = slim.select(
        "conv_id", F.row_number().over(order).alias("position"), "role", "text", state.alias("state"), F.lead(F.lit(True)).over(order).isNull().alias("last")
    )
    legal = F.lit(False)
    for at, roles in template.follows.items():
        legal = legal | ((F.col("state") == at) & role.isin(*roles))
    name = F.concat(F.lit(template.other.before), escape(role, template), F.lit(template.between))
    before = F.concat(F.when(F.col("state") == START, template.begin).otherwise(""), _by_role(role, template, lambda t: t.before, name))
    after = _by_role(role, template, lambda t: t.after, template.other.after)
    loss = _by_role(role, template, lambda t: t.loss, template.other.loss)
    piece = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
    segments = F.array(piece(before, F.lit(False)), piece(escape(F.col("text"), template), loss), piece(after, F.lit(False)))
    return placed.select("conv_id", "position", "role", "state", legal.alias("legal"), "last", segments.alias("segments"))


def format_conversations(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, n_turns, faults (illegal turns, and an illegal end), formatted, segments.

    ``format_turns`` has dealt the turns by conversation, so they are gathered without another shuffle.
    """
    fault = (~F.col("legal")).cast("long") + (F.col("last") & ~F.col("role").isin(*template.ends)).cast("long")
    whole = format_turns(rows, template).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum(fault).alias("faults"), F.array_sort(F.collect_list(F.struct("position", "segments"))).alias("turns")
    )
    segments = F.flatten(F.col("turns.segments"))
    joined = whole.select("conv_id", "n_turns", "faults", segments.alias("segments"))
    return joined.select("conv_id", "n_turns", "faults", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text) of the turns in a formatted text, found by their markers."""
    mark = re.escape
    kinds = [*template.turns.values(), template.other]
    turn = "|".join(rf"{mark(t.before)}[\s\S]*?{mark(t.after)}" for t in kinds)

    def read(found: Column) -> Column:
        cut = lambda t: F.substring(found, F.lit(len(t.before) + 1), F.length(found) - len(t.before) - len(t.after))
        inside = cut(template.other)
        at = F.locate(template.between, inside)
        role, text = F.substring(inside, F.lit(1), at - 1), F.substring(inside, at + len(template.between), F.length(inside))
        for name, t in template.turns.items():
            here = found.startswith(t.before)
            role, text = F.when(here, F.lit(name)).otherwise(role), F.when(here, cut(t)).otherwise(text)
        return F.struct(unescape(role, template).alias("role"), unescape(text, template).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(turn), F.lit(0)), read)


def learned_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, as it was before it was escaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")


def digests(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation: turns and learned text read back from the formatted output, as counts and digests."""
    out = format_conversations(rows, template)
    read = out.select("conv_id", "faults", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted"), template).alias("turns"), learned_text(F.col("segments"), template).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars", "faults",
    )
