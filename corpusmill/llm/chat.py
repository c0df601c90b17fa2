r"""Chat formatting by prefix-target expansion, with built-in expressions only.

Every assistant turn becomes one example: all turns before it as context, and its own text as the only part to train
on. A conversation that does not end with an assistant turn has one more example without a trained part, so the examples hold every turn.

A turn is ``### role:``, a line break, the text, ``</turn>`` and a line break. In texts and roles ``\`` is
written ``\\``, ``<`` is ``\l`` and ``#`` is ``\h``, in roles ``:`` is ``\c``; so no text holds a mark and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "### ", ":\n", "</turn>\n"
SIGNS = (("<", "\\l"), ("#", "\\h"))
ROLE_SIGNS = (*SIGNS, (":", "\\c"))


def _replaced(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escaped(c: Column, signs: tuple = SIGNS) -> Column:
    out = _replaced(c, "\\", "\\\\")
    for sign, written in signs:
        out = _replaced(out, sign, written)
    return out


def unescaped(c: Column, signs: tuple = SIGNS) -> Column:
    """Inverse of ``escaped``. Doubled backslashes are taken out first, as pairs from the left."""

    def plain(part: Column) -> Column:
        for sign, written in signs:
            part = _replaced(part, written, sign)
        return part

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")


def examples(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """(key, example, text, loss_start, loss_chars, complete): one row per assistant turn, and the rest of a conversation.

    ``loss_start`` counts characters from 1; the mask covers ``loss_chars`` characters, none in a rest. ``complete`` marks the
    example that holds all turns. Turns are ordered by number, role and text, missing numbers first; a null role or text is
    empty; repeated rows are turns of their own; rows without a key are one conversation. Other columns are left out.
    """
    row = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    turns = conversations.groupBy(F.col(f"`{key}`").alias(key)).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    formatted = turns.select(
        F.col(f"`{key}`"),
        F.transform("turns", lambda t: t["role"] == trained).alias("trains"),
        F.transform("turns", lambda t: escaped(t["text"])).alias("texts"),
        F.transform("turns", lambda t: F.concat(F.lit(HEAD), escaped(t["role"], ROLE_SIGNS), F.lit(MIDDLE))).alias("heads"),
    )
    last = F.size("trains") - 1
    at = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("trains", i) | (i == last))
    ends = formatted.select(F.col(f"`{key}`"), F.explode(at).alias("example"), "trains", "texts", "heads")
    i = F.col("example")
    written = F.zip_with(
        F.slice("heads", 1, i + 1), F.slice("texts", 1, i + 1), lambda head, body: F.concat(head, body, F.lit(TAIL))
    )
    chars = F.when(F.get("trains", i), F.length(F.get("texts", i))).otherwise(0)
    whole = ends.select(
        F.col(f"`{key}`"), "example", F.array_join(written, "").alias("text"), chars.alias("loss_chars"),
        F.length(F.get("texts", i)).alias("own"), (i == last).alias("complete"),
    )
    start = F.length("text") - len(TAIL) - F.col("own") + 1
    return whole.select(F.col(f"`{key}`"), "example", "text", start.alias("loss_start"), "loss_chars", "complete")


def read_turns(text: Column) -> Column:
    """The turns of an example as an array of (role, text)."""
    parts = F.filter(F.split(text, TAIL, -1), lambda part: part != "")

    def one(part: Column) -> Column:
        colon = F.instr(part, ":")
        return F.struct(
            unescaped(F.substring(part, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1), ROLE_SIGNS).alias("role"),
            unescaped(F.substring(part, colon + len(MIDDLE), F.length(part))).alias("text"),
        )

    return F.transform(parts, one)


def read_trained(text: Column, start: Column, chars: Column) -> Column:
    """The text under the loss mask, as it was before escaping."""
    return unescaped(F.substring(text, start, chars))
