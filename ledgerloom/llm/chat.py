"""Chat formatting by a grammar round trip, as column expressions.

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]" text "</s>"

A conversation is rendered as it is, reparsed by splitting at the control strings, and the recovered
turns are compared with the source. Turns that do not come back are escaped (a backslash and a letter
stand for a control string, two backslashes for one) and the conversation is rendered and parsed again;
should it still differ, every turn is escaped. The reader undoes escapes in the same way in every round.

Defined results: a null text or role is empty; turns are ordered by turn (null first), role and text, so
that ties have one order; repeated rows are turns of their own; rows without a conversation id form one
conversation with a null id; an empty table gives an empty table; other columns are ignored. A formatted
conversation is one value, so a conversation must fit in one row, however it is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, START, END = "<s>[INST] ", " [/INST]", "<s>", "</s>"
CONTROLS = {"<s>": "\\b", "</s>": "\\e", "[INST]": "\\i", "[/INST]": "\\j"}


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, code in CONTROLS.items():
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    def part(piece: Column) -> Column:
        for control, code in CONTROLS.items():
            piece = F.replace(piece, F.lit(code), F.lit(control))
        return piece

    parts = F.transform(F.split(text, r"\\\\", -1), part)
    return F.when(F.instr(text, "\\") > 0, F.array_join(parts, "\\")).otherwise(text)


def rendered(turns: Column) -> Column:
    """Texts of turns (struct of role and text), one a turn."""
    return F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END)))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation; a text outside the grammar gives turns that differ from any source."""
    raw = F.filter(F.split(formatted, r"</s>", -1), lambda x: x != "")

    def turn(x: Column) -> Column:
        head = F.instr(x, CLOSE)
        role = F.substr(x, F.lit(len(OPEN) + 1), head - len(OPEN) - 1)
        text = F.substr(x, head + len(CLOSE))
        sound = x.startswith(OPEN) & (head > 0)
        return F.struct(
            F.when(sound, unescaped(role)).alias("role"),
            F.when(sound, unescaped(text)).alias("text"),
            F.when(sound, head + len(CLOSE) - 1).alias("before"),
            F.when(sound, F.length(text)).alias("length"),
        )

    return F.transform(raw, turn)


def _pairs(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _whole(turns: Column) -> Column:
    return F.array_join(rendered(turns), "")


def _escaped_turn(t: Column) -> Column:
    return F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"))


def _conflicts(t: Column) -> Column:
    """A turn that does not come back when it is rendered and parsed alone."""
    back = _pairs(parsed(F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))))
    return ~F.coalesce(back == F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.lit(False))


def format_chats(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted``, the rounds it took and ``loss_spans``.

    ``loss_spans`` are code point ranges (start, end) of ``formatted`` with the texts of ``learn`` turns.
    """
    clean = rows.select(
        F.col(id).alias("_id"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    grouped = clean.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("_turn", "_role", "_text"))).alias("_sorted"))
    pairs = F.transform("_sorted", lambda t: F.struct(t["_role"].alias("role"), t["_text"].alias("text")))
    df = grouped.select("_id", pairs.alias("_turns"))
    df = df.withColumn("_plain", _whole(F.col("_turns")))
    df = df.withColumn("_ok0", _pairs(parsed(F.col("_plain"))) == F.col("_turns"))
    some = F.transform("_turns", lambda t: F.when(_conflicts(t), _escaped_turn(t)).otherwise(t))
    df = df.withColumn("_first", F.when(F.coalesce("_ok0", F.lit(False)), F.col("_plain")).otherwise(_whole(some)))
    df = df.withColumn("_ok1", F.coalesce(F.col("_ok0"), F.lit(False)) | F.coalesce(_pairs(parsed(F.col("_first"))) == F.col("_turns"), F.lit(False)))
    df = df.withColumn("formatted", F.when(F.col("_ok1"), F.col("_first")).otherwise(_whole(F.transform("_turns", _escaped_turn))))
    rounds = F.when(F.coalesce("_ok0", F.lit(False)), 0).when(F.col("_ok1"), 1).otherwise(2)
    df = df.withColumns({"rounds": rounds, "_back": parsed(F.col("formatted"))})
    spans = F.aggregate(
        "_back",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: _advance(acc, t, learn),
        lambda acc: acc["spans"],
    )
    return df.select(F.col("_id").alias(id), "formatted", "rounds", spans.alias("loss_spans"))


def _advance(acc: Column, t: Column, learn: str) -> Column:
    start = acc["at"] + t["before"]
    end = start + t["length"]
    span = F.array(F.struct(start.alias("start"), end.alias("end")))
    return F.struct((end + len(END)).alias("at"), F.when(t["role"] == learn, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))


def read_chats(formatted: DataFrame, id: str = "conv_id") -> DataFrame:
    """What a reader gets back from ``formatted`` and ``loss_spans``: the turns, and the texts under the mask."""
    texts = F.transform("loss_spans", lambda s: unescaped(F.substr("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    return formatted.select(F.col(id), "formatted", _pairs(parsed(F.col("formatted"))).alias("turns"), texts.alias("loss_texts"))
