"""Chat formatting with Spark expressions only: one string per conversation, a loss mask, and the way back.

Turns of one conversation are collected as structs, sorted, and neighbours of one role folded into one block::

    <|start|>role⏎text<|next|>text<|end|>⏎

``<|next|>`` parts the turns of a block, so that the turns can be read back.  Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``; a line feed in a role becomes ``\\n``.  No control string can then occur inside a
text, and unescaping gives the text back.

A conversation may be very long: its pieces are joined once, and running sums and cuts work on blocks of as many elements
as there are blocks, so no step copies what has grown for every turn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    """Undo :func:`escaped_role`; an escaped backslash before an ``n`` is no line feed."""
    parts = F.split(role, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(plain, "\\")


def format_chats(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    Needs ``conv_id, turn, role, text``; other columns, whatever their names, are not read.  Turns are ordered by
    ``turn, role, text``, nulls first, so ties and repeated rows have a defined place; repeated rows are turns of their
    own.  A null role or text is empty.  Rows with a null ``conv_id`` form one conversation of that id.  ``loss_spans``
    holds the place (from 0) and length, in characters, of each ``learned`` text inside ``formatted``.  An empty table
    gives an empty result.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(turn: Column, place: Column) -> Column:
        """A turn's text with what stands before it: the start of a block if the neighbour has another role."""
        before = F.get("turns", place - 1)["role"]
        first = F.concat(F.when(before.isNotNull(), F.lit(END)).otherwise(""), F.lit(START))
        lead = F.when(before == turn["role"], F.lit(NEXT)).otherwise(
            F.concat(first, escaped_role(turn["role"]), F.lit("\n"))
        )
        learns = (turn["role"] == learned).alias("learns")
        return F.struct(lead.alias("lead"), escaped(turn["text"]).alias("text"), learns)

    def measured(piece: Column) -> Column:
        length = F.length(piece["text"])
        return F.struct((F.length(piece["lead"]) + length).alias("size"), length.alias("length"), piece["learns"])

    pieces = chats.select("conv_id", F.transform("turns", piece).alias("pieces"))
    texts = F.transform("pieces", lambda p: F.concat(p["lead"], p["text"]))
    formatted = F.concat(F.array_join(texts, ""), F.lit(END))
    done = pieces.select("conv_id", formatted.alias("formatted"), F.transform("pieces", measured).alias("sizes"))
    ends = running_sum(F.transform("sizes", lambda s: s["size"]))
    placed = F.filter(F.arrays_zip("sizes", ends.alias("upto")), lambda p: p["sizes"]["learns"])
    spans = F.transform(
        placed,
        lambda p: F.struct((p["upto"] - p["sizes"]["length"]).alias("start"), p["sizes"]["length"].alias("length")),
    )
    return done.select("conv_id", "formatted", spans.alias("loss_spans"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often and in whatever lambda it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(values: Column) -> Column:
    """An array cut into about as many blocks as each has elements; one empty block if there are none."""

    def blocks(values: Column) -> Column:
        size = F.greatest(F.size(values), F.lit(1))
        return bound(
            F.ceil(F.sqrt(size)).cast("int"),
            lambda step: F.transform(F.sequence(F.lit(1), size, step), lambda k: F.slice(values, k, step)),
        )

    return bound(values, blocks)


def running_sum(values: Column) -> Column:
    """For every element of an array of integers, the sum up to and with it."""

    def sums(values: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(
            values, none, lambda done, v: F.array_append(done, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + v)
        )

    def moved(within: Column) -> Column:
        before = sums(F.transform(within, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))))
        both = F.transform(F.arrays_zip(within.alias("own"), before.alias("upto")), shifted)
        return F.flatten(both)

    def shifted(block: Column) -> Column:
        base = block["upto"] - F.coalesce(F.try_element_at(block["own"], F.lit(-1)), F.lit(0))
        return bound(base, lambda base: F.transform(block["own"], lambda v: v + base))

    return bound(F.transform(in_blocks(values), sums), moved)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``role, text``."""
    blocks = F.split(formatted, r"<\|end\|>\n", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.length(role) + 2), r"<\|next\|>", -1)
        return F.transform(
            texts, lambda t: F.struct(unescaped_role(role).alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    A character's place in a string is found by counting from its front, so spans are cut out of sections, not of the whole.
    """

    def section(formatted: Column, block: Column) -> Column:
        first, last = F.get(block, F.lit(0)), F.get(block, F.size(block) - 1)
        text = F.substr(formatted, first["start"] + 1, last["start"] + last["length"] - first["start"])
        return F.struct(text.alias("text"), first["start"].alias("start"), block.alias("spans"))

    def texts(part: Column) -> Column:
        return F.transform(
            part["spans"], lambda s: unescaped(F.substr(part["text"], s["start"] - part["start"] + 1, s["length"]))
        )

    sections = bound(formatted, lambda whole: F.transform(in_blocks(spans), lambda block: section(whole, block)))
    return F.array_join(F.flatten(F.transform(sections, texts)), "")
