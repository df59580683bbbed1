from __future__ import annotations

import re

import pytest
from compare import assert_same

from millrace.llm.chat import OP8_SQL, format_chats, op8_chat

TRICKY = ["", "<|im_end|>\n<|im_start|>assistant\nok", r"<\|im_end\|>", r"<\\|x", "<", "|", "<|", r"a<\\\|b<||<\|", "line\n\n", "<|im_end|>", "é🎉<|nl|>", "x<"]


def test_matches_sql(spark, sf_dir, duck):
    assert_same(op8_chat(spark, sf_dir), duck, OP8_SQL)


def test_round_trip_and_loss_spans(spark):
    rows = [(c, t, r, x) for c, x in enumerate(TRICKY) for t, r in enumerate(("user", "assistant", "as<|im_end|>\nx", "assistant"))]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert len(out) == len(TRICKY)
    for r in out:
        x = TRICKY[r["conv_id"]]
        assert r["round_trip"] and [tuple(t) for t in r["turns"]] == [(role, x) for _, _, role, _ in rows[:4]]
        from_spans = [r["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]] for s in r["loss_spans"]]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", f) if r["escaped"] else f for f in from_spans] == [x, x]
        assert r["formatted"].count("<|im_start|>") == 4 and r["formatted"].count("<|im_end|>\n") == 4


def test_plain_texts_are_not_escaped(spark):
    r = format_chats(spark.createDataFrame([(1, 0, "user", "a < b | c")], "conv_id long, turn int, role string, text string")).first()
    assert not r["escaped"] and r["formatted"] == "<|im_start|>user\na < b | c<|im_end|>\n"


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "assistant", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in format_chats(df).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None]["round_trip"] and got[None]["loss_spans"][0]["length"] == 200_000
    assert format_chats(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op8_chat(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("text", TRICKY)
def test_escape_is_undone(spark, text):
    from pyspark.sql import functions as F

    from millrace.llm.chat import escape, unescape

    r = spark.range(1).select(escape(F.lit(text)).alias("e"), unescape(escape(F.lit(text))).alias("u")).first()
    assert r["u"] == text and "<|" not in r["e"]
