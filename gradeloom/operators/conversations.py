"""Rendering of conversations stored as one row per turn.

``turn`` gives the order of the messages; it may start anywhere and have gaps. A
rendered conversation is one row, as it is one sequence for everything that follows,
so its messages are gathered in a single grouping by conversation.
"""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions import chat

PART_TURNS = 4096


def gather_messages(turns):
    """``(conv_id, messages)`` with the messages of a conversation in order."""
    fields = [c for c in turns.columns if c not in ("conv_id", "turn")]
    return turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", *fields))).alias("messages")
    )


def render_conversations(turns, generation_prompt=False, tool_turns=False, tools=None, json_is_spaced=True):
    """``(conv_id, rendered)``.

    ``tool_turns``: assistant turns may carry ``tool_calls`` and there may be tool
    turns; ``turns`` then needs a ``tool_calls`` column. ``tools``, an array column of
    JSON texts made of literals, puts the tools header in place of the system message.
    """
    messages = F.col("messages")
    first = messages[0]

    def plain(message):
        return chat.segment(message["role"], message["text"])

    def any_message(message, at):
        calls = F.coalesce(F.size(message["tool_calls"]), F.lit(0)) > 0
        return (
            F.when(
                message["role"] == "tool",
                chat.tool_response_segment(
                    message["text"],
                    F.get(messages, at - 1)["role"],
                    F.get(messages, at + 1)["role"],
                ),
            )
            .when(
                (message["role"] == "assistant") & calls,
                chat.tool_calls_segment(message["text"], message["tool_calls"]),
            )
            .otherwise(plain(message))
        )

    def body(message, at):
        text = any_message(message, at) if tool_turns else plain(message)
        if tools is None:
            return text
        in_header = (at == 0) & (message["role"] == "system")
        return F.when(in_header, F.lit("")).otherwise(text)

    if tools is None:
        opening = chat.default_system_segment(first["role"])
    else:
        opening = chat.tools_header(first["role"], first["text"], tools, json_is_spaced)
    rendered = [opening, F.array_join(F.transform(messages, body), "")]
    if generation_prompt:
        rendered.append(F.lit(C.GENERATION_PROMPT))
    return gather_messages(turns).select("conv_id", F.concat(*rendered).alias("rendered"))


def label_turns(turns, part_turns=PART_TURNS):
    """Add ``use``: the last assistant turn is the completion, the turns before it
    the prompt, those after it neither (``after``); null without such a turn.

    The answer's place is found per conversation and joined per part, so that a
    very long conversation is never one key of the join.
    """
    answer = F.max(F.when(F.col("role") == "assistant", F.col("turn")))
    answers = turns.groupBy("conv_id").agg(
        answer.alias("answer_turn"), F.max("turn").alias("_last")
    )
    parts = F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / part_turns))
    answers = answers.select("conv_id", "answer_turn", F.explode(parts).alias("_part"))
    turn, last = F.col("turn"), F.col("answer_turn")
    return (
        turns.withColumn("_part", F.floor(turn / part_turns))
        .join(answers, ["conv_id", "_part"])
        .withColumn(
            "use",
            F.when(turn < last, "prompt")
            .when(turn == last, "completion")
            .when(turn > last, "after"),
        )
        .drop("answer_turn", "_part")
    )
