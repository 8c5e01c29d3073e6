"""Chat formatting by Spark expressions: collected turn structs are sorted, adjacent turns of one role
are merged, and the parts are concatenated under a template that can be read back without loss.

Template: `<|role|>` opens a block of adjacent turns of one role, `<|next|>` parts the turns inside a
block, `<|end|>` closes it. In roles and texts `&`, `<` and `[` are written as `&amp;`, `&lt;` and
`&#91;`, so no control string of this or another template survives inside them. Null roles and texts
are empty. Turns are ordered by turn number, nulls first, then by role and text; repeated rows are
turns of their own. Conversations with a null id form one conversation. An empty table gives none.
A conversation is one string by definition, so one conversation's turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT, END = "<|", "|>", "<|next|>", "<|end|>"
#: role whose texts count for the loss
LOSS_ROLE = "assistant"
#: the reversible escapes, in the order of writing
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def _role(text: Column) -> Column:
    """A role as the template writes it; the bar of a closing mark is escaped too."""
    return F.replace(escape(text), F.lit("|"), F.lit("&#124;"))


def _read_role(text: Column) -> Column:
    return unescape(F.replace(text, F.lit("&#124;"), F.lit("|")))


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: id, formatted, loss (the mask: spans of start and length, in code points).

    A span covers one assistant text as it is written in `formatted`, without any mark around it.
    """
    line = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    convs = turns.groupBy(F.col(conv_col).alias("id")).agg(F.array_sort(F.collect_list(line)).alias("turns"))

    def role_at(i: Column) -> Column:
        return F.get(F.col("turns"), i)["role"]

    last = F.size("turns") - 1
    parts = F.transform(
        "turns",
        lambda t, i: F.struct(
            F.when(
                (i > 0) & (role_at(i - 1) == t["role"]), F.lit(NEXT)
            ).otherwise(F.concat(F.lit(OPEN), _role(t["role"]), F.lit(CLOSE))).alias("mark"),
            escape(t["text"]).alias("body"),
            F.when((i == last) | (role_at(i + 1) != t["role"]), F.lit(END)).otherwise(F.lit("")).alias("close"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        ),
    )
    convs = convs.select("id", parts.alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["mark"], p["body"], p["close"])), "")
    runs = F.transform(
        "parts",
        lambda p: F.struct(
            F.length(p["mark"]).cast("long").alias("before"),
            F.length(p["body"]).cast("long").alias("chars"),
            F.length(p["close"]).cast("long").alias("after"),
            p["loss"].alias("loss"),
        ),
    )
    sized = convs.select("id", formatted.alias("formatted"), runs.alias("runs"))
    spans = F.aggregate(
        "runs",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,chars:bigint>>").alias("spans")),
        lambda acc, r: F.struct(
            (acc["at"] + r["before"] + r["chars"] + r["after"]).alias("at"),
            F.when(
                r["loss"],
                F.array_append(
                    acc["spans"], F.struct((acc["at"] + r["before"]).alias("start"), r["chars"].alias("chars"))
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return sized.select(F.col("id").alias(conv_col), "formatted", spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), one for each original turn."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        cut = F.instr(block, CLOSE)
        role = _read_role(F.substring(block, F.lit(3), cut - 3))
        texts = F.split(F.substring(block, cut + len(CLOSE), F.length(block)), r"<\|next\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int")))
        ),
        "",
    )
