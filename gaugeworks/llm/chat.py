"""Conversations as training text, one example for each reply.

Every assistant turn becomes an example of its own: all turns before it are its
context, and only its text is under the loss mask. Turns after the last reply make
one more example without a mask, so that nothing of a conversation is lost. A turn
is written as ``<s>role``, a line feed, its text and ``</s>``. Control strings
inside texts get a backslash after their first sign, and ones that look so already
get one more; reading back takes one away, so every text returns as it was.

The turns of a conversation are shuffled once. Examples follow within the
partition, and what is read back per conversation needs no second shuffle. A
conversation is one value, like a text, since its digest is taken over it as a
whole; its examples are cut from one formatted text, one row at a time.

A null text or role is empty; a null conversation id is a conversation of its own;
a null turn number comes first. Rows with equal turn numbers are ordered by role and
text, and repeated rows are turns like others. Other columns are ignored. No rows, no
examples.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strings that end or begin something in the template or in common ones.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
START, END, REPLY = "<s>", "</s>", "assistant"
#: The two turns of conversation -1, which the query adds.
PLANTED_ID, PLANTED_TEXT = -1, "</s>[INST] ok [/INST]"


def _openings(backslashes: str) -> str:
    """The first sign of a control string that has ``backslashes`` after it."""
    ends = "|".join(f"{re.escape(c[0])}(?={backslashes}{re.escape(c[1:])})" for c in CONTROLS)
    return f"({ends})"


def escaped(text: Column) -> Column:
    """No control string is left; none contains another's first sign, so none arises at a border."""
    return F.regexp_replace(text, _openings(r"\\*"), r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _openings(r"\\+") + r"\\", "$1")


def escaped_role(role: Column) -> Column:
    """A role ends at the line feed."""
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    plain = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescaped(F.replace(plain, F.lit("\\\\"), F.lit("\\")))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END))


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, last, text, loss_start, loss_end``: code points, end exclusive, from 0.

    ``example`` counts from 1 within the conversation, ``last`` marks the one that holds all turns; an
    example without a reply has an empty mask at its end. Partitioned by ``conv_id``.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: formatted_turn(t["role"], t["text"]))
    replies = F.transform("turns", lambda t: t["role"] == REPLY)
    # The end of each turn in the conversation's formatted text.
    lengths = F.transform("written", lambda t: F.length(t).cast("long"))
    ends = F.aggregate(
        lengths,
        F.array().cast("array<long>"),
        lambda done, n: F.concat(done, F.array(n + F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)))),
    )
    numbers = F.sequence(F.lit(1), F.size("written"))
    targets = F.filter(numbers, lambda i: F.element_at("replies", i) | (i == F.size("written")))
    parts = (
        whole.select("conv_id", written.alias("written"), replies.alias("replies"))
        .withColumn("ends", ends)
        .select(
            "conv_id",
            F.concat_ws("", "written").alias("all"),
            F.posexplode(
                F.transform(
                    targets,
                    lambda i: F.struct(
                        F.element_at("ends", i).alias("end"),
                        F.element_at("replies", i).alias("reply"),
                        # The text of the target: its turn without head and end mark.
                        (
                            F.length(F.element_at("written", i)) - F.instr(F.element_at("written", i), "\n") - len(END)
                        ).alias("chars"),
                        (i == F.size("written")).alias("last"),
                    ),
                )
            ).alias("at", "target"),
        )
    )
    target = F.col("target")
    loss_end = F.when(target["reply"], target["end"] - len(END)).otherwise(target["end"])
    return parts.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        target["last"].alias("last"),
        F.left("all", target["end"]).alias("text"),
        (loss_end - F.when(target["reply"], target["chars"]).otherwise(0)).alias("loss_start"),
        loss_end.alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """The turns of an example, read back as ``role``, ``text``."""
    pieces = F.split(text, re.escape(END))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        whole,
        lambda piece: F.struct(
            unescaped_role(F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescaped(F.substr(piece, F.instr(piece, "\n") + 1)).alias("text"),
        ),
    )


def read_back(made: DataFrame) -> DataFrame:
    """What a conversation's examples hold: all its turns, and the text under their masks in order."""
    loss = F.substr("text", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    read = made.select(
        "conv_id",
        F.struct("example", unescaped(loss).alias("loss")).alias("learnt"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
        F.length("text").cast("long").alias("chars"),
    )
    grouped = read.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.collect_list("learnt").alias("learnt"), F.sum("chars").alias("formatted_chars")
    )
    turns = grouped.withColumn("turns", turns_of(F.col("whole")))
    texts = turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("said"),
        F.concat_ws("", F.transform(F.sort_array("learnt"), lambda l: l["loss"])).alias("loss"),  # noqa: E741
        "formatted_chars",
    )
    return texts.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_planted(conversations: DataFrame) -> DataFrame:
    """The columns used, and two more turns whose texts are made of control strings."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(REPLY))
    planted = conversations.sparkSession.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PLANTED_TEXT).alias("text")
    )
    return rows.unionByName(planted)
