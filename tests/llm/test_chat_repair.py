"""Repairs against a search of all edits, and the query against a plain computation."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from plumbline.llm import chat_repair as cr
from plumbline.llm.common import read
from plumbline.llm.queries import QUERIES

COLUMNS = "conv_id long, turn long, role string, text string"


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0d]", text)
        out.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, lines) by trying every edit at every row; the audit is compared as a whole text."""
    n = len(rows)

    @lru_cache(None)
    def best(i, done, inserted):
        """Best (cost, audit, lines) of the rows from i on after the initials ``done`` (nothing, s, or the last of u and a)."""
        found = []
        if i == n and done in ("", "a"):
            found.append((0, "", ()))
        turn = "a" if done == "u" else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if inserted < 3:
            cost, audit, lines = best(i, turn, inserted + 1)
            found.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        if i < n:
            role, text = rows[i]
            cost, audit, lines = best(i + 1, done, 0)
            found.append((cost + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                stays = 3 if faults[i] == "truncated" else 0
                cost, audit, lines = best(i + 1, turn, 0)
                found.append((cost + 3 + stays, "R" + audit, (f"{name}:{text}", *lines)))
                if role[:1] == turn or (role[:1] == "s" and done == ""):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    found.append((cost + stays, "K" + audit, (f"{role}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def plain(rows):
    """The query's answer for rows (conv, turn, role, text) that are damaged already, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())
        mine = sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=key)
        pairs = [(r, x) for *_, r, x in mine]
        faults = first_faults(pairs)
        turns = [t for _, t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, lines = cheapest(tuple(pairs), tuple(faults))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_audits_equal_a_search_of_all_edits():
    random.seed(2)
    texts = ["Yes.", "No", "Well?", "", " \n", "One!", "two", "three.", "four.", "five.", "six", "seven."]
    roles = ["user", "assistant", "system", "tool", "", "u", "user", "assistant"]
    for _ in range(4000):
        rows = tuple((random.choice(roles), random.choice(texts)) for _ in range(random.randint(0, 9)))
        faults = tuple(first_faults(rows))
        audit = cr.Audit()
        for (role, _), fault in zip(rows, faults):
            audit.add(role[:1], fault)
        cost, pieces = audit.finish()
        assert (cost, "".join(p for p, _ in pieces)) == cheapest(rows, faults)[:2]


def test_order_holds_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(cr, "_MODULUS", 3)
    test_audits_equal_a_search_of_all_edits()


def test_query_on_any_rows(spark):
    random.seed(4)
    texts = ["Yes.", "No", "Well? ", "", None, "One!\n", "two", "three.", "É.", "five.", "six", "x.\x0b"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(random.choice([None, *range(60)]), random.choice([None, *range(12)]), random.choice(roles), random.choice(texts)) for _ in range(420)]
    rows += rows[:30] + [(900, 5, None, None), (901, None, "user", "Hi.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", step string, digest int").repartition(4)
    assert got(cr.digests(df, df)) == plain(rows)


def test_damage_and_query_on_the_sample(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain(damaged(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(QUERIES["op11_chat_repair"](spark, folder)) == {c: want.get(c, nothing) for c in {r[0] for r in rows}}


def test_damage_with_nulls(spark):
    random.seed(8)
    rows = [(random.choice([None, *range(30)]), random.choice([None, *range(9)]), random.choice(["user", None]), random.choice(["Ab. c!", None])) for _ in range(300)]
    out = [tuple(r) for r in cr.damage(spark.createDataFrame(rows, COLUMNS)).collect()]
    assert sorted(out, key=str) == sorted(damaged(rows), key=str)


def test_long_conversations_and_long_texts(spark):
    rows = [(1, i, ("user", "assistant", "tool")[i % 3], f"turn {i}" + "." * (i % 2)) for i in range(30_000)] + [(2, 0, "user", "a b " * 300_000 + "."), (2, 1, "assistant", "Yes.")]
    result = got(cr.digests(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(rows, COLUMNS).select("conv_id")))
    text = f"user:{rows[-2][3]}\nassistant:Yes."
    assert result[2] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(text.encode()).hexdigest())
    done = cr.Audit()
    for _, _, role, text in rows[:30_000]:
        done.add(role[0], None if text.endswith(".") else "truncated")
    cost, pieces = done.finish()
    assert result[1][5:7] == (cost, "".join(p for p, _ in pieces))


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "user", "Bye"), (2, 0, "user", " ")]
    done = cr.repair(spark.createDataFrame(rows, COLUMNS))
    turns = [tuple(r) for r in done.turns.orderBy("conv_id", "step").select("conv_id", "edit", "role", "text").collect()]
    assert turns[:2] == [(1, "K", "system", "Be kind."), (1, "I", "user", "")] and all(t[0] == 1 for t in turns)
    edits = [tuple(r) for r in done.edits.orderBy("conv_id", "step").select("conv_id", "edit", "cost").collect()]
    assert edits == [(1, "K", 0), (1, "I", 3), (1, "K", 0), (1, "D", 4), (1, "D", 4), (2, "D", 4)]


@pytest.mark.parametrize("ids", [[], [5, None]])
def test_no_rows_after_damage(spark, ids):
    none = spark.createDataFrame([], COLUMNS)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(cr.digests(none, spark.createDataFrame([(i,) for i in ids], "conv_id long"))) == {i: nothing for i in ids}
