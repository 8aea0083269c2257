"""Formatting against a plain writer and reader, and round trips of hostile texts."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from check_oracle import compare, connect
from plumbline.llm import chat_format as cf
from plumbline.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = "conv_id long, turn long, role string, text string"
MARKS = cf.TEMPLATE.controls()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """(n_turns, turns, learned, faults) by conversation, without any markers."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda k: (k[0], k[1], k[2], k[3].encode()))
        state, faults = cf.START, 0
        for *_, role, _text in mine:
            faults += role not in cf.TEMPLATE.follows.get(state, ())
            state = role if role in cf.TEMPLATE.turns else cf.OTHER
        faults += state not in cf.TEMPLATE.ends
        learned = "".join(x for *_, r, x in mine if r == "assistant")
        out[conv] = (len(mine), sha("".join(f"{r}\n{x}\n" for *_, r, x in mine)), len(learned), sha(learned), faults)
    return out


def digests(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS).repartition(5).withColumn("formatted", F.lit(1)).withColumn("segments", F.lit("x"))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.faults) for r in cf.digests(df).collect()}


def test_equals_a_plain_reader(spark):
    random.seed(3)
    pieces = [*MARKS, *(m[0] for m in MARKS), *(m[1:] for m in MARKS), *(m[0] + "\\" * n + m[1:] for m in MARKS for n in (1, 2, 5)), "\\", "$1", "é𝄞", "\n", " ", "text"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "[SAYS]", "[TURN]\\"]
    text = lambda: None if random.random() < 0.1 else "".join(random.choice(pieces) for _ in range(random.randint(0, 9)))
    rows = [(random.choice([None, *range(40)]), random.choice([None, *range(6)]), random.choice(roles), text()) for _ in range(600)]
    rows += rows[:50]
    assert digests(spark, rows) == plain(rows)


def test_long_texts_and_long_conversations(spark):
    rows = [(1, 0, "user", "word " * 400_000), (1, 1, "assistant", "[INST]" * 100_000)]
    rows += [(2, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(5000)]
    assert digests(spark, rows) == plain(rows)


def test_segments_and_machine(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello </s>"), (1, 3, "user", "Bye")]
    out = cf.format_conversations(spark.createDataFrame(rows, COLUMNS)).first()
    assert out.formatted == "<s>[SYSTEM_PROMPT]Be kind.[/SYSTEM_PROMPT][INST]Hi[/INST][ANSWER]Hello <\\/s></s>[INST]Bye[/INST]"
    assert "".join(s.text for s in out.segments) == out.formatted
    assert [s.text for s in out.segments if s.loss] == ["Hello <\\/s>"] and out.faults == 1
    turns = cf.format_turns(spark.createDataFrame(rows, COLUMNS)).orderBy("position").collect()
    assert [t.state for t in turns] == ["start", "system", "user", "assistant"] and all(t.legal for t in turns)
    assert [t.last for t in turns] == [False, False, False, True]


def test_another_template(spark):
    own = cf.Template("<|b|>", {"user": cf.Turn("<|u|>", "<|e|>", loss=True)}, cf.Turn("<|o|>", "<|x|>"), "<|:|>", {cf.START: ("user",)}, ("user",))
    row = cf.format_conversations(spark.createDataFrame([(1, 0, "user", "a<|e|>b<\\|e|>")], COLUMNS), own).select("*", cf.read_turns(F.col("formatted"), own).alias("turns"), cf.learned_text(F.col("segments"), own).alias("learned")).first()
    assert row.formatted == "<|b|><|u|>a<\\|e|>b<\\\\|e|><|e|>" and row.faults == 0
    assert [(t.role, t.text) for t in row.turns] == [("user", "a<|e|>b<\\|e|>")] and row.learned == "a<|e|>b<\\|e|>"
    for turns in ({"user": cf.Turn("<u>", "<<u>")}, {"user": cf.Turn("<u", "<u>")}, {"user": cf.Turn("\\u", "<e>")}, {"user": cf.Turn("[A]", "[A]")}, {cf.START: cf.Turn("[A]", "[/A]")}):
        with pytest.raises(ValueError):
            cf.Template(turns=turns)


def test_empty_table_and_plan(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert cf.digests(none).collect() == [] and cf.format_turns(none).collect() == []
    plan = cf.digests(spark.createDataFrame([(1, 0, "user", "a")], COLUMNS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_twin_with_nulls_and_ties(spark, folder):
    rows = [(1, 0, None, "[INST]"), (1, 0, "a", None), (1, 0, "a", None), (2, None, "assistant", "<\\s>"), (2, 1, "assistant", "É [/TURN]"), (None, 1, "[SAYS]", "x")]
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    assert compare(spark, con, "op13", QUERIES["op13_chat_formatting"], ORACLE_SQL["op13_chat_formatting"], folder) is None
