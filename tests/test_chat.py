from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.functions import chat
from gradeloom.operators import conversations, examples

CALLS = [("search", '{"q": "a"}'), ("open", '{"n": 1}')]
SCHEMA = (
    "conv_id long, turn long, role string, text string, "
    "tool_calls array<struct<name:string,arguments:string>>"
)
ROLES = {
    1: ["user", "assistant", "tool", "tool", "assistant", "tool", "user"],
    2: ["system", "user", "system", "assistant"],
    3: ["tool", "tool", "tool", "tool", "tool", "user", "assistant", "tool"],
    4: ["assistant"],
}


def turns(spark):
    rows = []
    for conv, roles in ROLES.items():
        for turn, role in enumerate(roles):
            calls = CALLS[: turn % 3] if role == "assistant" else None
            text = "" if calls and conv == 1 else f"{role} {turn}\nof {conv}"
            rows.append((conv, turn, role, text, calls))
    return rows, spark.createDataFrame(rows, SCHEMA)


def rendered_by_hand(messages, generation=False):
    """The chat format, message by message."""
    out = ""
    if messages[0][0] != "system":
        out += f"<|im_start|>system\n{C.DEFAULT_SYSTEM}<|im_end|>\n"
    for at, (role, text, calls) in enumerate(messages):
        if role == "tool":
            if at == 0 or messages[at - 1][0] != "tool":
                out += "<|im_start|>user"
            out += f"\n<tool_response>\n{text}\n</tool_response>"
            if at + 1 == len(messages) or messages[at + 1][0] != "tool":
                out += "<|im_end|>\n"
        elif role == "assistant" and calls:
            out += "<|im_start|>assistant" + (f"\n{text}" if text else "")
            for name, arguments in calls:
                out += f'\n<tool_call>\n{{"name": "{name}", "arguments": {arguments}}}\n</tool_call>'
            out += "<|im_end|>\n"
        else:
            out += f"<|im_start|>{role}\n{text}<|im_end|>\n"
    return out + (C.GENERATION_PROMPT if generation else "")


@pytest.mark.parametrize("generation", [False, True])
@pytest.mark.parametrize("first_turn, step", [(0, 1), (1, 1), (5, 3)])
def test_conversations(spark, generation, first_turn, step):
    """The order of the turns counts, not where it starts or what it skips."""
    rows, df = turns(spark)
    df = df.withColumn("turn", F.col("turn") * step + first_turn)
    out = conversations.render_conversations(df, generation, True)
    found = {row["conv_id"]: row["rendered"] for row in out.collect()}
    for conv in ROLES:
        messages = [r[2:] for r in rows if r[0] == conv]
        assert found[conv] == rendered_by_hand(messages, generation)


def test_tools_header_stands_for_the_system_message(spark):
    rows, df = turns(spark)
    tools = F.array(F.lit('{"a": 1}'))
    out = conversations.render_conversations(df, True, True, tools)
    found = {row["conv_id"]: row["rendered"] for row in out.collect()}
    for conv in ROLES:
        messages = [r[2:] for r in rows if r[0] == conv]
        own = messages[0][0] == "system"
        given = rendered_by_hand(messages, True)
        head = f"<|im_start|>system\n{messages[0][1] if own else C.DEFAULT_SYSTEM}"
        rest = given[len(head + "<|im_end|>\n"):]
        assert found[conv].startswith(head + "\n\n# Tools") and found[conv].endswith(rest)
        assert found[conv].count("<|im_start|>") == given.count("<|im_start|>")


def test_row_rendering(spark):
    messages = [("user", "hi"), ("assistant", "ho")]
    df = spark.createDataFrame([(messages,)], "m array<struct<role:string,content:string>>")
    plain = [(r, c, None) for r, c in messages]
    got = df.select(chat.render(F.col("m")), chat.render(F.col("m"), True)).first()
    assert got[0] == rendered_by_hand(plain)
    assert got[1] == rendered_by_hand(plain, generation=True)


def test_wrapped_calls(spark):
    wrapped = "array<struct<function:struct<name:string,arguments:string>>>"
    df = spark.createDataFrame([("", [((CALLS[0]),)])], f"text string, calls {wrapped}")
    calls = chat.unwrap_calls(F.col("calls"))
    got = df.select(chat.tool_calls_segment(F.col("text"), calls)).first()[0]
    head = f"<|im_start|>system\n{C.DEFAULT_SYSTEM}<|im_end|>\n"
    assert head + got == rendered_by_hand([("assistant", "", CALLS[:1])])


@pytest.mark.parametrize("part_turns", [1, 2, 4096])
def test_label_turns(spark, part_turns):
    _, df = turns(spark)
    uses = defaultdict(dict)
    for row in conversations.label_turns(df, part_turns).collect():
        uses[row["conv_id"]][row["turn"]] = row["use"]
    assert uses[1] == dict.fromkeys(range(4), "prompt") | {4: "completion", 5: "after", 6: "after"}
    assert uses[4] == {0: "completion"}
    assert uses[2][3] == "completion"


def test_prompt_completion(spark):
    output = ("SCHEMA_ERROR", "it's gone", 'say "it\'s"')
    df = spark.createDataFrame(
        [(1, "Do it.", "It broke.", output)],
        "example_id long, instruction string, input string, "
        "output struct<category:string,root_cause:string,recommendation:string>",
    )
    row = examples.prompt_completion(df).first()
    assert [m["role"] for m in row["prompt"]] == ["system", "user"]
    assert row["prompt"][1]["content"] == "Do it.\n\nETL Failure:\nIt broke."
    names = ["category", "root_cause", "recommendation"]
    assert row["completion"][0]["content"] == str(dict(zip(names, output)))
    as_json = examples.prompt_completion(df, as_json=True).first()
    assert as_json["completion"][0]["content"].startswith('{"category":"SCHEMA_ERROR"')


def test_tools_header_without_tools_text_changes(spark):
    df = spark.createDataFrame([("user", "x", ['{"a": 1}'])], "r string, c string, t array<string>")
    got = df.select(chat.tools_header(F.col("r"), F.col("c"), F.col("t"))).first()[0]
    assert got.startswith(f"<|im_start|>system\n{C.DEFAULT_SYSTEM}\n\n# Tools\n\n")
    assert '<tools>\n{"a": 1}\n</tools>' in got
    assert got.endswith("</tool_call><|im_end|>\n")


def test_judge_prompt_is_stripped_and_holds_its_fields(spark):
    df = spark.createDataFrame([("f", "a", "b", "c", "d")], "f string, a string, b string, c string, d string")
    got = df.select(chat.judge_prompt(*[F.col(c) for c in "fabcd"])).first()[0]
    assert got == got.strip()
    for (heading, _), value in zip(C.JUDGE_FIELDS, "fabcd"):
        assert f"\n{heading}:\n{value}\n" in got
    for flag in [*C.JUDGE_FLAGS, "explanation"]:
        assert f'"{flag}"' in got
