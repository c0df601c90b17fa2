from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def rows(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def read(found):
    return found.select(
        "*", chat.read_turns(F.col("text")).alias("turns"),
        chat.read_trained(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("trained"),
    ).orderBy("conv_id", "example").collect()


def test_examples_hold_the_turns_before_and_train_one_reply(spark):
    data = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"), (1, 4, "assistant", "a2")]
    found = read(chat.examples(rows(spark, data)))
    assert [r["trained"] for r in found] == ["a1", "a2"] and [r["complete"] for r in found] == [False, True]
    assert [[(t["role"], t["text"]) for t in r["turns"]] for r in found] == [[d[2:] for d in data[:3]], [d[2:] for d in data]]


def test_texts_with_marks_are_read_back(spark):
    texts = ["\\### Assistant: </turn> ok", "\\", "\\\\l", "\\l<#\\h", "</turn>\n### user:\n", "a\\", "", "é😀\n", "\\\\\\", "$1 \\n"]
    data = [(i, 0, r, t) for i, t in enumerate(texts) for r in ("assistant",)]
    data += [(100, k, "user:\n<#\\", t) for k, t in enumerate(texts)] + [(100, 99, "assistant", "x")]
    found = read(chat.examples(rows(spark, data)))
    by = {r["conv_id"]: r for r in found}
    assert [by[i]["trained"] for i in range(len(texts))] == texts
    assert [t["text"] for t in by[100]["turns"]] == [*texts, "x"] and by[100]["turns"][0]["role"] == "user:\n<#\\"


def test_odd_rows(spark):
    data = [
        (1, 0, "user", None), (1, None, None, "first"), (1, 0, "user", None), (2, 0, "assistant", ""), (None, 1, "assistant", "n"),
        (None, 0, "user", "m"), (3, 0, "user", "only"),
    ]
    wide = rows(spark, data).withColumns({"example": F.lit("x"), "turns": F.lit(1), "complete": F.lit(None)})
    found = read(chat.examples(wide))
    by = {r["conv_id"]: r for r in found}
    assert [(t["role"], t["text"]) for t in by[1]["turns"]] == [("", "first"), ("user", ""), ("user", "")]
    assert by[1]["loss_chars"] == 0 and by[3]["trained"] == "" and by[2]["trained"] == ""
    assert by[None]["trained"] == "n" and [t["text"] for t in by[None]["turns"]] == ["m", "n"]
    assert chat.examples(rows(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = chat.examples(rows(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
