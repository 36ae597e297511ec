"""Chat formatting with Spark expressions only: a reversible template and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template. All begin with "<" or "[".
OPEN, CLOSE = "<s>", "</s>"
TURN, SAYS, NEXT, END = "[TURN]", "[SAYS]", "[NEXT]", "[/TURN]"


def escape(text: Column) -> Column:
    """No "<" or "[" of the result begins a control string, of this template or another: a backslash follows it."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_conversations(rows: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted``.

    Turns are the rows of a ``conv_id`` (null is a conversation of its own), sorted by turn, then role, then text, nulls
    first; null texts and roles are empty. Adjacent turns of one role share one block:
    ``<s>[TURN]role[SAYS]text[NEXT]text[/TURN]...</s>``. ``segments`` are the pieces of ``formatted`` in order, ``loss``
    marking those to learn: exactly the escaped texts of ``learn_role``. Rows that repeat are turns of their own. An
    empty table gives no conversations. Other columns are not read.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = F.col("turns")
    role = lambda i: F.get(turns, i)["role"]
    starts = lambda t, i: (i == 0) | (t["role"] != role(i - 1))
    ends = lambda t, i: (i == F.size(turns) - 1) | (t["role"] != role(i + 1))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            turns,
            lambda t, i: F.array(
                piece(
                    F.concat(
                        F.when(i == 0, F.lit(OPEN)).otherwise(F.lit("")),
                        F.when(starts(t, i), F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS))).otherwise(F.lit(NEXT)),
                    ),
                    F.lit(False),
                ),
                piece(escape(t["text"]), t["role"] == F.lit(learn_role)),
                piece(
                    F.concat(
                        F.when(ends(t, i), F.lit(END)).otherwise(F.lit("")),
                        F.when(i == F.size(turns) - 1, F.lit(CLOSE)).otherwise(F.lit("")),
                    ),
                    F.lit(False),
                ),
            ),
        ),
    )
    return (
        rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select("conv_id", segments.alias("segments"))
        .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``."""
    body = F.substring(formatted, len(OPEN) + 1, F.char_length(formatted) - len(OPEN) - len(CLOSE))
    blocks = F.split(body, r"\[/TURN\]")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)  # nothing follows the last end mark

    def turns(block: Column) -> Column:
        head = F.split(F.substring(block, len(TURN) + 1, F.char_length(block)), r"\[SAYS\]")
        return F.transform(
            F.split(F.get(head, F.lit(1)), r"\[NEXT\]"),
            lambda text: F.struct(unescape(F.get(head, F.lit(0))).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped piece by piece."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
