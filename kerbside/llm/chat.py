"""Chat formatting by a grammar round trip, in DataFrame functions only.

Rendered form of a conversation::

    <|im_start|>role
    text<|im_end|>

once per turn, each followed by a line feed. The reader cuts at every
``<|im_start|>``, ends a turn at the first ``<|im_end|>`` and takes one level
of escapes off: ``<\\|`` stands for ``<|``, ``<\\\\|`` for ``<\\|`` and so on, and
``<|nl|>`` inside a role for a line feed. The writer renders a turn as it is,
reads it back, and only where something else comes back escapes the turn and
compares again; an escaped turn holds no control string, so the second
comparison cannot fail.

Defined cases: a null text or role is the empty string; turns are ordered by
turn (null first), then role, then text; repeated rows are turns of their own;
a null conv_id is a conversation of its own; an empty table gives no rows;
other columns are ignored. A conversation is one output row, so its turns meet
in one task; nothing else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escaped(text: Column) -> Column:
    """One more backslash between ``<`` and ``|`` wherever only backslashes lie between them."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(BREAK))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(BREAK), F.lit("\n")))


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parsed(formatted: Column) -> Column:
    """Turns of a rendered text as an array of structs.

    ``start`` (from 0) and ``length`` place the raw text in the rendered one,
    in code points. Text before the first control string is no turn.
    """
    pieces = F.split(formatted, F.lit(r"<\|im_start\|>"), -1)
    segments = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    cut = F.transform(
        segments,
        lambda s: F.struct(
            F.length(s).alias("size"),
            F.substring_index(s, "\n", 1).alias("role"),
            F.substring_index(F.substr(s, F.length(F.substring_index(s, "\n", 1)) + 2), END, 1).alias("raw"),
        ),
    )
    ends = F.aggregate(
        cut,
        F.struct(F.length(F.substring_index(formatted, START, 1)).cast("long").alias("at"), F.array().cast("array<long>").alias("starts")),
        lambda acc, x: F.struct(
            (acc.at + len(START) + x.size).alias("at"),
            F.concat(acc.starts, F.array(acc.at + len(START) + F.length(x.role) + 1)).alias("starts"),
        ),
    ).starts
    return F.transform(
        F.arrays_zip(cut.alias("c"), ends.alias("e")),
        lambda x: F.struct(
            unescaped_role(x.c.role).alias("role"),
            unescaped(x.c.raw).alias("text"),
            x.e.alias("start"),
            F.length(x.c.raw).cast("long").alias("length"),
        ),
    )


def _turn_reads_back(role: Column, text: Column) -> Column:
    """Whether a turn rendered as it is comes back as the one same turn."""
    raw = rendered_turn(role, text)
    segments = F.split(raw, F.lit(r"<\|im_start\|>"), -1)
    body = F.element_at(segments, 2)
    read_role = F.substring_index(body, "\n", 1)
    read_text = F.substring_index(F.substr(body, F.length(read_role) + 2), END, 1)
    return (F.size(segments) == 2) & (unescaped_role(read_role) == role) & (unescaped(read_text) == text)


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns and loss_spans.

    ``loss_spans`` is the mask over the assistant texts: start (from 0) and
    length in code points of the formatted text, before unescaping.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    clean = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    fits = _turn_reads_back(F.col("role"), F.col("text"))
    rendered = F.when(fits, rendered_turn(F.col("role"), F.col("text"))).otherwise(
        rendered_turn(escaped_role(F.col("role")), escaped(F.col("text")))
    )
    grouped = (
        clean.select("conv_id", F.struct("turn", "role", "text", rendered.alias("rendered")).alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("ts"))
        .select("conv_id", F.array_join(F.col("ts.rendered"), "").alias("formatted"))
    )
    read = grouped.withColumn("turns", parsed(F.col("formatted")))
    loss = F.transform(
        F.filter("turns", lambda t: t.role == "assistant"),
        lambda t: F.struct(t.start.alias("start"), t.length.alias("length")),
    )
    return read.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), loss.alias("loss_spans"))
