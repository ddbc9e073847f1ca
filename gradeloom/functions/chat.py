"""Chat messages and their rendering, as expressions over one row.

A message is ``struct<role, content>``; a conversation is an array of them.
"""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions.text import record_literal, spaced_json


def message(role, content):
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_content(instruction, failure):
    return F.concat(instruction, F.lit(C.FAILURE_HEADING), failure)


def analysis_messages(failure, system=C.DEFAULT_SYSTEM):
    """System and user message that ask for an analysis of one failure."""
    return F.array(
        message("system", F.lit(system)),
        message("user", user_content(F.lit(C.ANALYSIS_INSTRUCTION), failure)),
    )


def completion_text(output, as_json=False):
    """The output record as text: Python literal form, or JSON."""
    if as_json:
        return F.to_json(output)
    return record_literal([(name, output[name]) for name in C.REQUIRED_OUTPUT_FIELDS])


def prompt_messages(instruction, failure, system=C.DEFAULT_SYSTEM):
    return F.array(
        message("system", F.lit(system)),
        message("user", user_content(instruction, failure)),
    )


def completion_messages(output):
    return F.array(message("assistant", completion_text(output)))


def judge_prompt(
    failure,
    reference_root_cause,
    predicted_root_cause,
    reference_recommendation,
    predicted_recommendation,
):
    values = [
        failure,
        reference_root_cause,
        predicted_root_cause,
        reference_recommendation,
        predicted_recommendation,
    ]
    parts = [F.lit(C.JUDGE_OPENING)]
    for (heading, _), value in zip(C.JUDGE_FIELDS, values):
        parts += [F.lit(f"\n\n{heading}:\n"), value]
    return F.concat(*parts, F.lit("\n\n" + C.JUDGE_RUBRIC))


def judge_messages(prompt):
    return F.array(message("system", F.lit(C.JUDGE_SYSTEM)), message("user", prompt))


def segment(role, content):
    """One plain message in the chat format."""
    return F.concat(
        F.lit(C.IM_START), role, F.lit("\n"), content, F.lit(C.IM_END + "\n")
    )


def default_system_segment(first_role):
    """The system line that opens a conversation without one of its own."""
    opening = segment(F.lit("system"), F.lit(C.DEFAULT_SYSTEM))
    return F.when(first_role == "system", F.lit("")).otherwise(opening)


def render(messages, generation_prompt=False):
    """A conversation of plain messages as one string."""
    body = F.array_join(
        F.transform(messages, lambda m: segment(m["role"], m["content"])), ""
    )
    parts = [default_system_segment(messages[0]["role"]), body]
    if generation_prompt:
        parts.append(F.lit(C.GENERATION_PROMPT))
    return F.concat(*parts)


def tools_header(first_role, first_content, tools, json_is_spaced=True):
    """The system block of a conversation with tools.

    ``tools`` is an array of JSON texts, one per tool. Compact JSON, as
    ``to_json`` writes it, is given the usual spaces first.
    """
    lines = tools if json_is_spaced else F.transform(tools, spaced_json)
    system = F.when(first_role == "system", first_content).otherwise(
        F.lit(C.DEFAULT_SYSTEM)
    )
    listing = F.array_join(F.transform(lines, lambda t: F.concat(F.lit("\n"), t)), "")
    return F.concat(
        F.lit(C.IM_START + "system\n"),
        system,
        F.lit(C.TOOLS_INTRO),
        listing,
        F.lit(C.TOOLS_OUTRO + C.IM_END + "\n"),
    )


def tool_calls_segment(content, calls, json_is_spaced=True):
    """An assistant message that calls tools.

    ``calls`` is ``array<struct<name, arguments>>`` with the arguments as JSON
    text; calls wrapped in ``function`` go through :func:`unwrap_calls` first.
    """
    lead = F.when(
        F.coalesce(content, F.lit("")) != "", F.concat(F.lit("\n"), content)
    ).otherwise(F.lit(""))

    def one(call):
        arguments = call["arguments"]
        return F.concat(
            F.lit('\n<tool_call>\n{"name": "'),
            call["name"],
            F.lit('", "arguments": '),
            arguments if json_is_spaced else spaced_json(arguments),
            F.lit("}\n</tool_call>"),
        )

    return F.concat(
        F.lit(C.IM_START + "assistant"),
        lead,
        F.array_join(F.transform(calls, one), ""),
        F.lit(C.IM_END + "\n"),
    )


def unwrap_calls(wrapped):
    """``array<struct<function>>`` to the plain array of calls."""
    return F.transform(wrapped, lambda call: call["function"])


def tool_response_segment(content, previous_role, next_role):
    """A tool message; neighbours that are tool messages share one block."""
    opening = F.when(
        F.coalesce(previous_role, F.lit("")) != "tool", F.lit(C.IM_START + "user")
    ).otherwise(F.lit(""))
    closing = F.when(
        F.coalesce(next_role, F.lit("")) != "tool", F.lit(C.IM_END + "\n")
    ).otherwise(F.lit(""))
    return F.concat(
        opening,
        F.lit("\n<tool_response>\n"),
        content,
        F.lit("\n</tool_response>"),
        closing,
    )
