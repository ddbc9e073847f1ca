"""Prompts and chat rendering."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.catalog import sql as S
from gradeloom.catalog.data_queries import valid_examples
from gradeloom.catalog.fixtures import duckdb_ctes, fixture, table
from gradeloom.catalog.registry import query
from gradeloom.functions import chat
from gradeloom.operators import conversations, examples

_DEFAULT = S.text(C.DEFAULT_SYSTEM)
_HEADING = S.text(C.FAILURE_HEADING)
_INSTRUCTION = S.text(C.ANALYSIS_INSTRUCTION)


@query(
    "build_user_content",
    duckdb_ctes("examples")
    + f"SELECT example_id, instruction || {_HEADING} || input AS content FROM examples",
)
def build_user_content(spark, sf_dir):
    rows = fixture(spark, sf_dir, "examples")
    content = chat.user_content(F.col("instruction"), F.col("input"))
    return rows.select("example_id", content.alias("content"))


@query(
    "build_analysis_prompt",
    duckdb_ctes("eval_cases")
    + f"""SELECT case_id, 'system' AS role, {_DEFAULT} AS content FROM eval_cases
UNION ALL SELECT case_id, 'user', {_INSTRUCTION} || {_HEADING} || input FROM eval_cases""",
)
def build_analysis_prompt(spark, sf_dir):
    rows = fixture(spark, sf_dir, "eval_cases")
    messages = chat.analysis_messages(F.col("input"))
    return rows.select("case_id", F.inline(messages))


_BS = "chr(92)"
_ESCAPED = "{0}"
for _raw in [92, 10, 13, 9]:
    _letter = {92: _BS, 10: "'n'", 13: "'r'", 9: "'t'"}[_raw]
    _ESCAPED = f"replace({_ESCAPED}, chr({_raw}), {_BS} || {_letter})"


def _literal(column):
    escaped = _ESCAPED.format(column)
    return (
        f"CASE WHEN contains({column}, '''') AND NOT contains({column}, '\"') "
        f"THEN '\"' || {escaped} || '\"' "
        f"ELSE '''' || replace({escaped}, '''', {_BS} || '''') || '''' END"
    )


_RECORD = "'{' || " + " || ', ' || ".join(
    f"'''{name}'': ' || {_literal(name)}" for name in C.REQUIRED_OUTPUT_FIELDS
) + " || '}'"


@query(
    "completion_literal",
    duckdb_ctes("examples") + f"SELECT example_id, {_RECORD} AS completion FROM examples",
)
def completion_literal(spark, sf_dir):
    rows = valid_examples(spark, sf_dir)
    completion = chat.completion_text(F.col("output"))
    return rows.select("example_id", completion.alias("completion"))


@query(
    "prompt_completion",
    duckdb_ctes("examples")
    + f"""SELECT example_id, 'prompt' AS side, 'system' AS role, {_DEFAULT} AS content FROM examples
UNION ALL SELECT example_id, 'prompt', 'user', instruction || {_HEADING} || input FROM examples
UNION ALL SELECT example_id, 'completion', 'assistant', {_RECORD} FROM examples""",
)
def prompt_completion(spark, sf_dir):
    pairs = examples.prompt_completion(valid_examples(spark, sf_dir))

    def labelled(side):
        return F.transform(
            side, lambda m: F.struct(F.lit(side).alias("side"), m["role"], m["content"])
        )

    both = F.concat(labelled("prompt"), labelled("completion"))
    return pairs.select("example_id", F.inline(both)).toDF(
        "example_id", "side", "role", "content"
    )


@query(
    "training_text",
    duckdb_ctes("examples")
    + f"""SELECT example_id, {S.segment("'system'", _DEFAULT)}
 || {S.segment("'user'", f"instruction || {_HEADING} || input")}
 || {S.segment("'assistant'", _RECORD)} AS rendered FROM examples""",
)
def training_text(spark, sf_dir):
    pairs = examples.prompt_completion(valid_examples(spark, sf_dir))
    return examples.training_text(pairs).select("example_id", "rendered")


@query(
    "prompt_completion_conversations",
    """SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn < a.answer THEN 'prompt'
 WHEN c.turn = a.answer THEN 'completion' WHEN c.turn > a.answer THEN 'after' END AS "use"
FROM conversations c JOIN (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS answer
 FROM conversations GROUP BY conv_id) a ON c.conv_id = a.conv_id""",
)
def prompt_completion_conversations(spark, sf_dir):
    turns = conversations.label_turns(table(spark, sf_dir, "conversations"))
    return turns.select("conv_id", "turn", "role", "use")


_OPENING = (
    "CASE WHEN arg_min(role, turn) <> 'system' THEN "
    + S.segment("'system'", _DEFAULT) + " ELSE '' END"
)
_RENDERED = f"""SELECT conv_id, {_OPENING} ||
 string_agg({S.segment('role', 'text')}, '' ORDER BY turn) AS rendered
FROM conversations GROUP BY conv_id"""


@query("render_chat", _RENDERED)
def render_chat(spark, sf_dir):
    return conversations.render_conversations(table(spark, sf_dir, "conversations"))


@query(
    "render_generation_prompt",
    f"""SELECT conv_id, rendered || '<|im_start|>assistant' || chr(10) AS rendered
FROM ({_RENDERED}) AS r""",
)
def render_generation_prompt(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return conversations.render_conversations(turns, generation_prompt=True)


@query(
    "render_tools_header",
    f"""SELECT conv_id, '<|im_start|>system' || chr(10)
 || CASE WHEN role = 'system' THEN text ELSE {_DEFAULT} END || {S.text(C.TOOLS_INTRO)}
 || chr(10) || '{{"name": "lookup", "turn": ' || CAST(turn AS VARCHAR) || '}}'
 || chr(10) || '{{"name": "search: a,b", "conv": ' || CAST(conv_id AS VARCHAR) || '}}'
 || {S.text(C.TOOLS_OUTRO)} || '<|im_end|>' || chr(10) AS header
FROM conversations""".replace("{{", "{").replace("}}", "}"),
)
def render_tools_header(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    tools = F.array(
        F.to_json(F.struct(F.lit("lookup").alias("name"), "turn")),
        F.to_json(
            F.struct(F.lit("search: a,b").alias("name"), F.col("conv_id").alias("conv"))
        ),
    )
    header = chat.tools_header(F.col("role"), F.col("text"), tools, json_is_spaced=False)
    return turns.select("conv_id", header.alias("header"))


def tool_turns(spark, sf_dir):
    """Conversation turns with ``tool_calls``."""
    rows = fixture(spark, sf_dir, "tool_turns")
    call = F.transform(
        F.sequence(F.lit(1), "calls"),
        lambda k: F.struct(
            F.lit("lookup").alias("name"),
            F.concat(
                F.lit('{"turn": '), F.col("turn"), F.lit(', "call": '), k, F.lit("}")
            ).alias("arguments"),
        ),
    )
    calls = F.when(F.col("calls") > 0, call)
    return rows.select("conv_id", "turn", "role", "text", calls.alias("tool_calls"))


def _call(number):
    return (
        """chr(10) || '<tool_call>' || chr(10) || '{"name": "lookup", "arguments": {"turn": '"""
        f""" || CAST(turn AS VARCHAR) || ', "call": {number}' || '}}' || '}}'"""
        """ || chr(10) || '</tool_call>'"""
    ).replace("}}", "}")


_CALLS = (
    "'<|im_start|>assistant' || CASE WHEN text <> '' THEN chr(10) || text ELSE '' END || "
    f"{_call(1)} || CASE WHEN calls > 1 THEN {_call(2)} ELSE '' END || '<|im_end|>' || chr(10)"
)


@query(
    "render_tool_calls",
    duckdb_ctes("tool_turns")
    + f"""SELECT conv_id, turn, {_CALLS} AS rendered FROM tool_turns
WHERE role = 'assistant' AND calls > 0""",
)
def render_tool_calls(spark, sf_dir):
    calling = tool_turns(spark, sf_dir).where(
        "role = 'assistant' AND tool_calls IS NOT NULL"
    )
    rendered = chat.tool_calls_segment(F.col("text"), F.col("tool_calls"))
    return calling.select("conv_id", "turn", rendered.alias("rendered"))


@query(
    "render_tool_responses",
    duckdb_ctes("tool_turns")
    + f"""SELECT conv_id, {_OPENING} || string_agg(CASE WHEN role = 'tool' THEN CASE WHEN coalesce(before, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END
   || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>'
   || CASE WHEN coalesce(behind, '') <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END
  WHEN role = 'assistant' AND calls > 0 THEN {_CALLS}
  ELSE {S.segment('role', 'text')} END, '' ORDER BY turn) AS rendered
FROM (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS behind FROM tool_turns
 WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) AS t
GROUP BY conv_id""",
)
def render_tool_responses(spark, sf_dir):
    return conversations.render_conversations(tool_turns(spark, sf_dir), tool_turns=True)


_TOOLS = ['{"name": "lookup", "parameters": {}}', '{"name": "search"}']


@query(
    "render_with_tools",
    f"""SELECT conv_id, '<|im_start|>system' || chr(10)
 || CASE WHEN arg_min(role, turn) = 'system' THEN arg_min(text, turn) ELSE {_DEFAULT} END
 || {S.text(C.TOOLS_INTRO)} || chr(10) || {S.text(_TOOLS[0])} || chr(10) || {S.text(_TOOLS[1])}
 || {S.text(C.TOOLS_OUTRO)} || '<|im_end|>' || chr(10)
 || coalesce(string_agg({S.segment('role', 'text')}, '' ORDER BY turn)
  FILTER (WHERE role <> 'system' OR NOT is_first), '')
 || '<|im_start|>assistant' || chr(10) AS rendered
FROM (SELECT *, turn = min(turn) OVER (PARTITION BY conv_id) AS is_first FROM conversations) AS t
GROUP BY conv_id""",
)
def render_with_tools(spark, sf_dir):
    """Whole conversations with tools: the header stands for the system message."""
    turns = table(spark, sf_dir, "conversations")
    tools = F.array([F.lit(t) for t in _TOOLS])
    return conversations.render_conversations(turns, generation_prompt=True, tools=tools)


_JUDGE_CASES = """SELECT case_id, input AS failure, expected_root_cause AS a,
 upper(expected_root_cause) AS b, expected_recommendation AS c, lower(expected_recommendation) AS d
FROM eval_cases"""


def _judge_cases(spark, sf_dir):
    cases = fixture(spark, sf_dir, "eval_cases")
    prompt = chat.judge_prompt(
        F.col("input"),
        F.col("expected_root_cause"),
        F.upper("expected_root_cause"),
        F.col("expected_recommendation"),
        F.lower("expected_recommendation"),
    )
    return cases.withColumn("prompt", prompt)


_PROMPT = S.judge_prompt("failure", "a", "b", "c", "d")


@query(
    "build_judge_prompt",
    duckdb_ctes("eval_cases")
    + f"SELECT case_id, {_PROMPT} AS prompt FROM ({_JUDGE_CASES}) AS j",
)
def build_judge_prompt(spark, sf_dir):
    return _judge_cases(spark, sf_dir).select("case_id", "prompt")


@query(
    "build_judge_messages",
    duckdb_ctes("eval_cases")
    + f"""SELECT case_id, 'system' AS role, {S.text(C.JUDGE_SYSTEM)} AS content FROM eval_cases
UNION ALL SELECT case_id, 'user', {_PROMPT} FROM ({_JUDGE_CASES}) AS j""",
)
def build_judge_messages(spark, sf_dir):
    messages = chat.judge_messages(F.col("prompt"))
    return _judge_cases(spark, sf_dir).select("case_id", F.inline(messages))
