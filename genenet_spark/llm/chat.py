"""Chat formatting with Spark expressions (operator 9).

Turns of a conversation are collected as structs and sorted; runs of one role are
merged into one block; blocks are concatenated to one training text:

    <|user|>first text<|+|>second text of the same role<|end|>
    <|assistant|>answer<|end|>

The loss mask covers each assistant text, without the marks around and between.

Control strings inside texts and roles are escaped reversibly: a backslash, ``<``
and ``|`` become ``\\b``, ``\\l`` and ``\\p``. An escaped text holds neither ``<`` nor ``|``,
so no text can look like a mark, and marks can be split on without look-around.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT, END = "<|", "|>", "<|+|>", "<|end|>\n"
_ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("|", "\\p")]


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:  # the backslash first, so that no later one is coded twice
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_conversations(rows: DataFrame, loss_role: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` has ``start`` and ``end`` (code points, end exclusive) of each escaped text of ``loss_role``.

    Cases: null text and null role are empty; turns of equal number are in order of role, then text; repeated
    rows are repeated turns; null turn numbers come first; rows without a conversation id form one conversation
    of null id; other columns are ignored; an empty table gives no rows. A conversation is one output row, so
    its turns meet in one task; conversations are spread by hash of their id.
    """
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(escape(F.col(role_col).cast("string")), F.lit("")).alias("role"),
        F.coalesce(escape(F.col(text_col).cast("string")), F.lit("")).alias("text"))
    collected = rows.select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    heads = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (
        F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    collected = collected.withColumn("heads", heads)
    blocks = F.transform("heads", lambda h, k: F.struct(
        F.element_at("turns", h)["role"].alias("role"),
        F.transform(F.slice("turns", h, F.coalesce(F.get("heads", k + 1), F.size("turns") + 1) - h),
                    lambda t: t["text"]).alias("texts")))
    merged = collected.select("conv_id", blocks.alias("blocks"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit(CLOSE), F.array_join(b["texts"], NEXT), F.lit(END))), "")

    # Spans: walk over the blocks, then over the texts of one, with the place reached so far.
    span = "struct<start:bigint,end:bigint>"
    mark, gap, end = len(OPEN) + len(CLOSE), len(NEXT), len(END)

    def block_step(acc: Column, b: Column) -> Column:
        begin = acc["at"] + F.length(b["role"]) + mark
        inside = F.aggregate(
            b["texts"], F.struct(begin.cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans")),
            lambda a, t: F.struct((a["at"] + F.length(t) + gap).cast("long").alias("at"), F.concat(a["spans"], F.array(F.struct(
                a["at"].alias("start"), (a["at"] + F.length(t)).cast("long").alias("end")))).alias("spans")))
        return F.struct(
            (inside["at"] - gap + end).cast("long").alias("at"),
            F.when(b["role"] == F.lit(_escaped(loss_role)), F.concat(acc["spans"], inside["spans"])).otherwise(acc["spans"]).alias("spans"))

    walked = F.aggregate("blocks", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans")), block_step)
    return merged.select("conv_id", formatted.alias("formatted"), walked["spans"].alias("loss_spans"))


def _escaped(text: str) -> str:
    for plain, coded in _ESCAPES:
        text = text.replace(plain, coded)
    return text


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts, parsed from the formatted text and its spans alone.

    Adds ``turns`` (array of role and text, one for each input row) and ``loss_texts`` (array of strings).
    """
    # Every block ends with END; what follows the last one is empty.
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda b: b != "")
    turns = F.flatten(F.transform(pieces, lambda b: F.transform(
        F.split(F.substr(b, F.locate(CLOSE, b) + len(CLOSE)), r"<\|\+\|>", -1),
        lambda t: F.struct(unescape(F.substr(b, F.lit(len(OPEN) + 1), F.locate(CLOSE, b) - len(OPEN) - 1)).alias("role"),
                           unescape(t).alias("text")))))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumns({"turns": turns, "loss_texts": loss})
