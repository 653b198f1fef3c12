"""Rendering conversations with the chat template."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quern.functions.tokens import BOS, EOS

# The template's markers.
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>\n"
GENERATION_PROMPT = "<|im_start|>assistant\n"


def render_turns(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    add_generation_prompt: bool = False,
) -> DataFrame:
    """Each message as it appears in its rendered conversation, one row per message.

    The begin token precedes a first message of a user or system; after the last message
    comes the generation prompt if wanted, else the end token if an assistant spoke last.
    First and last messages are found by an aggregate that combines before its shuffle and
    are joined back on (conversation, turn), so a huge conversation spreads over many tasks.
    """
    # Turn and role in one integer keep the aggregate in the hash path with code generation.
    opens = F.col(role).isin("user", "system").cast("int")
    answers = (F.col(role) == "assistant").cast("int")
    edges = df.groupBy(conversation).agg(
        F.min(F.col(turn) * 2 + opens).alias("first"), F.max(F.col(turn) * 2 + answers).alias("last")
    )
    opening = F.when(F.col("first") % 2 == 1, F.lit(BOS)).otherwise(F.lit(""))
    if add_generation_prompt:
        closing = F.lit(GENERATION_PROMPT)
    else:
        closing = F.when(F.col("last") % 2 == 1, F.lit(EOS)).otherwise(F.lit(""))
    turn_of = lambda edge: F.shiftright(edge, 1).alias(turn)
    marks = (
        edges.select(
            conversation,
            F.explode(
                F.array(
                    F.struct(turn_of("first"), opening.alias("before"), F.lit("").alias("after")),
                    F.struct(turn_of("last"), F.lit("").alias("before"), closing.alias("after")),
                )
            ).alias("mark"),
        )
        .select(conversation, "mark.*")
        .groupBy(conversation, turn)
        .agg(F.max("before").alias("__before"), F.max("after").alias("__after"))
    )
    body = F.concat(
        F.lit(TURN_OPEN), F.col(role), F.lit("\n"), F.col(text), F.lit(TURN_CLOSE)
    )
    joined = df.join(marks, [conversation, turn], "left")
    return joined.select(
        conversation,
        turn,
        F.concat(
            F.coalesce("__before", F.lit("")), body, F.coalesce("__after", F.lit(""))
        ).alias("rendered"),
    )


def render_chat(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    add_generation_prompt: bool = False,
) -> DataFrame:
    """One rendered text per conversation: :func:`render_turns` concatenated in order.

    The result is one string, so a conversation is limited by a single value. Where
    conversations may exceed that, tokenize :func:`render_turns` and pack by (conversation, turn).
    """
    turns = render_turns(df, conversation, turn, role, text, add_generation_prompt)
    return turns.groupBy(conversation).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct(turn, "rendered")))["rendered"], "").alias("rendered"),
        F.count("*").alias("n_turns"),
    )
