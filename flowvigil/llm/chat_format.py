"""Conversations of typed content parts to one training string each, and back.

A message holds an array of parts ``struct<type, text, uri, units>``. Text parts
are escaped and kept; image, audio and document parts become ordered
placeholders, and each is recorded with its reference and the tokens it will
expand to. The mask says, turn by turn, how many code points are header, body
and tail, and whether the body counts for the loss. ``read_back`` undoes all of
it from the string and the mask alone.

Defined cases: a null text is empty, a null role is the empty role, a null part
list is an empty turn, null turns come first, equal turns are ordered by role
and content, an unknown part type is an attachment of that type with one unit
of ``document`` cost. Other columns of the input are ignored. One conversation
is one output row, so its turns meet in one task; nothing larger does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_OPEN = "<|turn:"
TURN_CLOSE = "|>\n"
TURN_END = "<|end|>\n"

#: Tokens a unit expands to: an image tile, a second of audio, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 600}

PART_TYPE = "struct<type:string,text:string,uri:string,units:bigint>"

#: Starts of control strings of this template and of common ones.
CONTROL_START = r"<(?=\|)|<(?=/?s>)"
BRACKET_START = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """No control string is left; ``unescape`` gives the text again."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    out = F.regexp_replace(out, CONTROL_START, "&lt;")
    return F.regexp_replace(out, BRACKET_START, "&lb;")


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("&lb;"), F.lit("["))
    out = F.replace(out, F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def text_parts(text: Column) -> Column:
    """A plain text as the part list with that one part."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("uri"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part)


def _placeholder(part: Column, turn: Column, position: Column) -> Column:
    return F.concat(
        F.lit("<|"), escape(part["type"]), F.lit(":"), turn.cast("string"), F.lit("."),
        position.cast("string"), F.lit("|>"),
    )


def _part_tokens(part: Column) -> Column:
    each = F.lit(UNIT_TOKENS["document"])
    for kind, tokens in UNIT_TOKENS.items():
        each = F.when(part["type"] == kind, F.lit(tokens)).otherwise(each)
    return each * F.coalesce(part["units"], F.lit(1).cast("bigint"))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _visit(message: Column, turn: Column) -> Column:
    """Flatten one message: role, body, its attachments."""
    parts = F.coalesce(message["parts"], F.array().cast(f"array<{PART_TYPE}>"))
    body = F.array_join(
        F.transform(
            parts,
            lambda part, k: F.when(_is_text(part), escape(part["text"])).otherwise(
                _placeholder(part, turn, k)
            ),
        ),
        "",
    )
    attachments = F.filter(
        F.transform(
            parts,
            lambda part, k: F.struct(
                turn.alias("turn"),
                k.alias("part"),
                F.coalesce(part["type"], F.lit("text")).alias("type"),
                part["uri"].alias("uri"),
                _part_tokens(part).alias("tokens"),
            ),
        ),
        lambda attachment: attachment["type"] != "text",
    )
    return F.struct(
        F.coalesce(message["role"], F.lit("")).alias("role"),
        body.alias("body"),
        attachments.alias("attachments"),
    )


def format_conversations(
    messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """``conv_id, turn, role, parts`` rows to one row per conversation.

    Returns ``conv_id, formatted, mask, attachments, attachment_tokens``; ``mask``
    is ``array<struct<header, body, tail, loss>>``, a run of lengths per turn.
    """
    rows = messages.select("conv_id", F.struct("turn", "role", "parts").alias("message"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("message")).alias("messages"))
    visited = grouped.select("conv_id", F.transform("messages", _visit).alias("turns"))
    header = lambda turn: F.concat(
        F.lit(TURN_OPEN), escape(turn["role"]), F.lit(TURN_CLOSE)
    )
    formatted = F.array_join(
        F.transform("turns", lambda turn: F.concat(header(turn), turn["body"], F.lit(TURN_END))), ""
    )
    mask = F.transform(
        "turns",
        lambda turn: F.struct(
            F.length(header(turn)).alias("header"),
            F.length(turn["body"]).alias("body"),
            F.lit(len(TURN_END)).alias("tail"),
            turn["role"].isin(*loss_roles).alias("loss"),
        ),
    )
    attachments = F.flatten(F.transform("turns", lambda turn: turn["attachments"]))
    shaped = visited.select(
        "conv_id",
        formatted.alias("formatted"),
        mask.alias("mask"),
        attachments.alias("attachments"),
    )
    tokens = F.aggregate(
        "attachments", F.lit(0).cast("bigint"), lambda total, item: total + item["tokens"]
    )
    return shaped.withColumn("attachment_tokens", tokens)


def read_back(formatted: Column, mask: Column) -> Column:
    """``array<struct<role, text, loss>>`` of a formatted string and its mask."""
    pieces = F.filter(
        F.split(formatted, r"<\|end\|>\n", -1), lambda piece: piece.startswith(TURN_OPEN)
    )
    return F.zip_with(
        pieces,
        mask,
        lambda piece, run: F.struct(
            unescape(
                F.substring(
                    piece,
                    F.lit(len(TURN_OPEN) + 1),
                    run["header"] - F.lit(len(TURN_OPEN) + len(TURN_CLOSE)),
                )
            ).alias("role"),
            unescape(F.substring(piece, run["header"] + F.lit(1), run["body"])).alias("text"),
            run["loss"].alias("loss"),
        ),
    )
