"""Chat formatting with typed content parts, in column expressions only.

A turn's content is an array of parts ``struct<kind, text, ref, units>``. The visitor ``visit_parts`` turns it into

* one text in which every attachment is a placeholder, numbered in order inside its turn,
* one attachment record per placeholder: kind, reference, position, and the tokens it will expand to.

Templates mark turns with control strings. Inside texts and roles the character that opens a control string is escaped
where it could be read as one, and ``unescape`` gives the exact text back.

Long conversations are formatted in blocks of 64 consecutive turn numbers, so that a conversation with
very many turns is many rows. Joined in order, the blocks of a conversation are its formatted text.

Defined results: null text is empty text, null role is an empty role, null parts are no parts, an unknown kind of part
is an attachment of zero tokens; turns are ordered by turn number (null first), then role, then content, and repeated
rows stay as repeated turns; an empty table gives an empty table. Conversations with null id form one conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a block holds turn numbers that agree without their last six bits
BLOCK_BITS = 6

PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


@dataclass(frozen=True)
class Template:
    """Control strings. Every one starts with ``<|`` and holds no other ``<``."""

    turn_start: str = "<|im_start|>"
    turn_end: str = "<|im_end|>\n"
    role_end: str = "\n"
    #: tokens per unit of an attachment (patches of an image, seconds of audio, pages of a document)
    tokens_per_unit: dict[str, int] = field(default_factory=lambda: {"image": 1, "audio": 25, "document": 600})
    loss_role: str = "assistant"


def escape(c: Column) -> Column:
    """Put a backslash after each ``<`` that a bar, a backslash or the end of the text follows."""
    return F.regexp_replace(c, r"<(?=[|\\]|\z)", r"<\\")


def unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<\\"), F.lit("<"))


def escape_role(c: Column) -> Column:
    """As ``escape``, and line ends are written so that the first one in a turn ends its role."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    pieces = F.split(unescape(c), r"\\\\", -1)  # at escaped backslashes, so that what is left are line ends
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def text_part(text: Column) -> Column:
    """A text as content with one part."""
    return F.array(
        F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                 F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"))
    )


def _attachments(parts: Column) -> Column:
    return F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: ~p["kind"].eqNullSafe("text"))


def visit_parts(parts: Column, template: Template) -> tuple[Column, Column]:
    """The flattened content, escaped, and its attachment records in order.

    Each part is visited once: text gives its escaped text, anything else the placeholder ``<|kind:number|>``.
    """
    parts = F.coalesce(parts, F.array().cast(PARTS))
    rates = F.create_map(*[F.lit(x) for pair in template.tokens_per_unit.items() for x in pair])
    kind = lambda p: F.regexp_replace(F.coalesce(p["kind"], F.lit("unknown")), "[^A-Za-z0-9_]", "_")
    numbered = F.transform(
        parts, lambda p, i: F.struct(p.alias("part"), F.size(_attachments(F.slice(parts, 1, i + 1))).alias("number"))
    )
    flat = F.array_join(
        F.transform(
            numbered,
            lambda x: F.when(x["part"]["kind"].eqNullSafe("text"), escape(F.coalesce(x["part"]["text"], F.lit(""))))
            .otherwise(F.concat(F.lit("<|"), kind(x["part"]), F.lit(":"), x["number"].cast("string"), F.lit("|>"))),
        ),
        "",
    )
    records = F.transform(
        _attachments(parts),
        lambda p, i: F.struct(
            kind(p).alias("kind"), p["ref"].alias("ref"), (i + 1).cast("int").alias("number"),
            (F.coalesce(F.try_element_at(rates, kind(p)), F.lit(0)) * F.coalesce(p["units"], F.lit(0)))
            .cast("bigint").alias("n_tokens"),
        ),
    )
    # content of text alone, the usual case, needs no walk over the parts
    only_text = (F.size(parts) == 1) & F.coalesce(F.get(parts, F.lit(0))["kind"] == "text", F.lit(False))
    plain = escape(F.coalesce(F.get(parts, F.lit(0))["text"], F.lit("")))
    return F.when(only_text, plain).otherwise(flat), records


def format_conversations(
    turns: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", parts: str = "parts",
) -> DataFrame:
    """Rows ``(conv_id, block, n_turns, formatted, loss_spans, attachments, n_attachment_tokens)``.

    ``loss_spans`` holds start (from 0) and length in code points, relative to the block's text, of every content of
    the role that is trained on. Only the turns of one block meet in one task's row.
    """
    flat, records = visit_parts(F.col(parts), template)
    header = F.concat(
        F.lit(template.turn_start), escape_role(F.coalesce(F.col(role).cast("string"), F.lit(""))), F.lit(template.role_end)
    )
    rendered = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.shiftright(F.col(turn).cast("bigint"), BLOCK_BITS).alias("block"),
        F.struct(
            F.col(turn).cast("bigint").alias("turn"), header.alias("header"), flat.alias("content"),
            F.col(role).eqNullSafe(template.loss_role).alias("trained"), records.alias("attachments"),
        ).alias("t"),
    )
    blocks = rendered.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    end = F.lit(template.turn_end)
    texts = F.transform("ts", lambda x: F.concat(x["header"], x["content"], end))
    # running length in front of each turn: one pass that keeps (length so far, spans)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.char_length(x["header"])
        stop = begin + F.char_length(x["content"])
        span = F.struct(begin.alias("start"), (stop - begin).alias("length"))
        return F.struct(
            (stop + len(template.turn_end)).alias("at"),
            F.when(x["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    attachments = F.flatten(F.transform("ts", lambda x: x["attachments"]))
    return blocks.select(
        "conv_id", "block", F.size("ts").cast("bigint").alias("n_turns"),
        F.array_join(texts, "").alias("formatted"),
        F.aggregate("ts", start, step, lambda s: s["spans"]).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda s, a: s + a["n_tokens"]).alias("n_attachment_tokens"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text, ``array<struct<role, text>>``; placeholders stay in the text."""
    pieces = F.filter(F.split(formatted, _quoted(template.turn_start), -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.split_part(p, F.lit(template.role_end), F.lit(1))
        begin = F.char_length(head) + len(template.role_end)
        length = F.char_length(p) - begin - len(template.turn_end)
        return F.struct(unescape_role(head).alias("role"), unescape(F.substring(p, begin + 1, length)).alias("text"))

    return F.transform(pieces, turn)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def join_blocks(blocks: DataFrame, column: str) -> DataFrame:
    """Join a text column over the blocks of each conversation, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("block", F.col(column).alias("text"))))
    return blocks.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda b: b["text"]), "").alias(column))


def _quoted(control: str) -> str:
    return r"\Q" + control + r"\E"
