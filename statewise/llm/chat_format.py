"""Chat formatting with Spark expressions: turns in order, same-role neighbours merged, texts escaped reversibly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template. Every mark begins with "<", which no escaped role or text holds.
OPEN, HEAD_END, NEXT, CLOSE = "<|role:", "<|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    """``text`` without "<": backslash becomes two, "<" becomes backslash and l."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``. Pairs of backslashes wait as "<", which no escaped text holds; then both swap."""
    once = F.replace(F.replace(text, F.lit("\\\\"), F.lit("<")), F.lit("\\l"), F.lit("\\"))
    return F.translate(once, "<\\", "\\<")


def _quoted(mark: str) -> str:
    return f"\\Q{mark}\\E"


def format_chats(
    turns: DataFrame,
    loss_role: str = "assistant",
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans.

    The turns of a conversation are collected as structs and sorted by turn; neighbours of the same role share one
    block, in which a mark stands between their texts, so that each turn can be read back. ``loss_spans`` has
    (start, len) in code points of ``formatted`` for every text of ``loss_role``; marks are never under the mask.
    A conversation becomes one string, so it must fit in a task; partial lists are collected before the shuffle.

    Defined results: a null text or role counts as empty; a null conversation id is a conversation of its own; a null
    turn comes first; rows with the same turn stand in the order of role and text, and repeated rows are all kept; an
    empty table gives no rows; other columns are ignored.
    """
    blank = F.lit("")
    collected = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col), blank).alias("role"),
                    F.coalesce(F.col(text_col), blank).alias("text"),
                )
            )
        ).alias("turns")
    )

    def piece(turn: Column, i: Column) -> Column:
        """What stands before the text, the text, and whether it is learned."""
        head = F.concat(F.lit(OPEN), escape(turn.role), F.lit(HEAD_END))
        before = F.element_at("turns", F.greatest(i, F.lit(1)))  # the turn before this one, as arrays count from 1
        lead = F.when(i == 0, head).when(before.role == turn.role, F.lit(NEXT)).otherwise(F.concat(F.lit(CLOSE), head))
        return F.struct(lead.alias("lead"), escape(turn.text).alias("text"), (turn.role == loss_role).alias("loss"))

    pieces = collected.select("conv_id", F.transform("turns", piece).alias("pieces"))
    span = "array<struct<start:int,len:int>>"
    walked = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("end"), F.array().cast(span).alias("spans")),
        lambda acc, p: F.struct(
            (acc.end + F.length(p.lead) + F.length(p.text)).alias("end"),
            F.when(
                p.loss,
                F.concat(
                    acc.spans,
                    F.array(F.struct((acc.end + F.length(p.lead)).alias("start"), F.length(p.text).alias("len"))).cast(span),
                ),
            )
            .otherwise(acc.spans)
            .alias("spans"),
        ),
    )
    return pieces.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p.lead, p.text)), ""), F.lit(CLOSE)).alias("formatted"),
        walked.spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back as an array of (role, text)."""

    def turns_of(block: Column) -> Column:
        head = F.substring_index(block, HEAD_END, 1)
        role = unescape(F.substr(head, F.lit(len(OPEN) + 1)))
        texts = F.split(F.substr(block, F.length(head) + len(HEAD_END) + 1), _quoted(NEXT), -1)
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    blocks = F.filter(F.split(formatted, _quoted(CLOSE), -1), lambda block: block != "")
    return F.flatten(F.transform(blocks, turns_of))


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substr(formatted, s.start + 1, s.len))), "")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the output of ``format_chats`` says when read back: counts and digests of turns and of learned text."""
    read = formatted.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "learned", learned_text(F.col("formatted"), F.col("loss_spans"))
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
