"""Tables derived from the given ones, in SQL that Spark and DuckDB both run.

The given data has no failure messages, model responses or run logs, so these
are put together from the rows of ``events`` and ``conversations``: one or more
derived rows per given row, so that the work grows with the data. ``{name}``
stands for a given table, ``@models@`` for a row per model name and ``@kinds@``
for a row per log entry.
"""

from gradeloom import constants as C
from gradeloom.sources.readers import read_table

# Six labels in turn.
_LABEL = """CASE {n} % 6 WHEN 0 THEN 'SCHEMA_ERROR' WHEN 1 THEN 'AUTH_ERROR'
 WHEN 2 THEN 'TIMEOUT_ERROR' WHEN 3 THEN 'QUOTA_ERROR'
 WHEN 4 THEN 'CONNECTION_ERROR' ELSE 'DATA_ERROR' END"""
# Six phrases that stand for them, in mixed case.
_PHRASE = """CASE {n} % 6 WHEN 0 THEN 'the target Schema changed'
 WHEN 1 THEN 'permission denied on write' WHEN 2 THEN 'the Time Limit was hit'
 WHEN 3 THEN 'a Rate Limit applied' WHEN 4 THEN 'connection reset by peer'
 ELSE 'an invalid value arrived' END"""


def _fill(text, **parts):
    for name, value in parts.items():
        text = text.replace("{" + name + "}", value)
    return text


EVAL_CASES = _fill(
    """SELECT event_id AS case_id,
 'The ' || event_type || ' stage failed for user ' || CAST(user_id AS STRING)
   || ' at record ' || CAST(event_id AS STRING) || '.' AS input,
 {label} AS expected_category,
 'The ' || event_type || ' stage for user ' || CAST(user_id AS STRING)
   || ' wrote a value the target could not accept.' AS expected_root_cause,
 'Check the ' || event_type || ' stage and rerun the load for user '
   || CAST(user_id AS STRING) || '.' AS expected_recommendation
FROM {events}""",
    label=_fill(_LABEL, n="event_id"),
)

# Ten ways to answer, sections missing, reordered, bold or padded.
RESPONSES = _fill(
    """SELECT response_id, case_id, model,
 CASE style
  WHEN 0 THEN 'Category: ' || label || nl || 'Root Cause: ' || cause || nl
       || 'Recommended Action: ' || advice
  WHEN 1 THEN '**Category:** ' || phrase || nl || '**Root Cause:** ' || cause || nl
       || '**Recommended Action:** ' || advice
  WHEN 2 THEN 'Recommended action: ' || advice || nl || 'Root cause: ' || cause || ' ' || phrase
  WHEN 3 THEN 'It looks like ' || phrase || ', nothing else is known.'
  WHEN 4 THEN label || ': the root cause is that ' || cause || ' My recommended action is to '
       || advice
  WHEN 5 THEN 'Root cause: unknown' || nl || 'RECOMMENDED ACTION: ' || advice || ' ' || label
  WHEN 6 THEN 'DATA_ERROR, or rather ' || label || '.' || nl || 'ROOT CAUSE:' || cause
  WHEN 7 THEN ''
  WHEN 8 THEN 'Root cause: ' || cause || nl || 'Recommended action: ' || advice
  ELSE nl || '  ' || lower(label) || nl || 'root cause:' || chr(9) || nl || cause || '  ' || nl
       || 'recommended action:' || nl || nl || advice || ' ' || chr(9) || nl END AS response
FROM (SELECT case_id * 2 + CASE WHEN model = 'tuned' THEN 1 ELSE 0 END AS response_id,
  case_id, model, chr(10) AS nl,
  (case_id + CASE WHEN model = 'tuned' THEN 3 ELSE 0 END) % 10 AS style,
  {label} AS label, {phrase} AS phrase,
  'The ' || event_type || ' stage for user ' || CAST(user_id AS STRING)
   || CASE WHEN guess % 2 = 0 THEN ' wrote a value the target refused.'
      ELSE ' sent a bad record.' END AS cause,
  CASE WHEN model = 'tuned' THEN 'Check the ' || event_type || ' stage and rerun the load.'
   ELSE 'Retry the load for user ' || CAST(user_id AS STRING) || '.' END AS advice
 FROM (SELECT event_id AS case_id, event_type, user_id, model,
   event_id + CASE WHEN model = 'tuned' THEN
     CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END
    ELSE CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END END AS guess
  FROM (SELECT event_id, event_type, user_id, @models@ AS model FROM {events}) AS doubled
 ) AS guessed) AS styled""",
    label=_fill(_LABEL, n="guess"),
    phrase=_fill(_PHRASE, n="guess"),
)

_FLAGS = (
    "'\"root_cause_correct\": ' || t1 || ', \"root_cause_has_unsupported_claim\": ' || t2"
    " || ', \"recommendation_appropriate\": ' || t3"
    " || ', \"recommendation_complete\": ' || t4"
)

# Judge answers: whole objects, fenced ones, prose around them, wrong kinds.
JUDGE_ANSWERS = _fill(
    """SELECT response_id, case_id, model,
 CASE style
  WHEN 0 THEN body
  WHEN 1 THEN fence || 'json' || nl || body || nl || fence
  WHEN 2 THEN fence || 'json' || nl || body
  WHEN 3 THEN fence || nl || body || nl || fence
  WHEN 4 THEN fence || 'JSON' || nl || body || nl || fence
  WHEN 5 THEN 'Here is my grade: ' || body
  WHEN 6 THEN body || nl || 'I hope this helps.'
  WHEN 7 THEN '{{' || {flags} || ', "explanation": "exactly19charactrs."}}'
  WHEN 8 THEN '{{' || {flags} || ', "explanation": "exactly 20 charactrs"}}'
  WHEN 9 THEN '{{"root_cause_correct": null, "explanation": "' || explanation || '"}}'
  WHEN 10 THEN '[' || body || ']'
  WHEN 11 THEN '{{' || {flags} || ', "explanation": 12345678901234567890123}}'
  ELSE nl || ' ' || chr(9) || body || nl END AS judge_response
FROM (SELECT *, '{{' || {flags} || ', "explanation": "' || explanation || '", "note": [1, 2]}}' AS body
 FROM (SELECT response_id, case_id, model, chr(10) AS nl,
   chr(96) || chr(96) || chr(96) AS fence, response_id % 13 AS style,
   CASE case_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN '"yes"' WHEN 3 THEN '1'
     WHEN 4 THEN 'true' WHEN 5 THEN '"Off"' ELSE 'false' END AS t1,
   CASE case_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN '0' ELSE 'false' END AS t2,
   CASE case_id % 5 WHEN 0 THEN 'false' WHEN 1 THEN '"T"' ELSE 'true' END AS t3,
   CASE case_id % 11 WHEN 0 THEN '2' WHEN 1 THEN '"maybe"' WHEN 2 THEN '"n"' WHEN 3 THEN 'false'
     ELSE 'true' END AS t4,
   'The ' || event_type || ' stage of user ' || CAST(user_id AS STRING) || ' was assessed.' AS explanation
  FROM (SELECT event_id * 2 + CASE WHEN model = 'tuned' THEN 1 ELSE 0 END AS response_id,
    event_id AS case_id, event_type, user_id, model
   FROM (SELECT event_id, event_type, user_id, @models@ AS model FROM {events}) AS doubled
  ) AS keyed) AS valued) AS built""",
    flags=_FLAGS,
)

# Valid training examples; texts with quotes, backslashes and line breaks.
EXAMPLES = """SELECT event_id AS example_id,
 '{instruction}' AS instruction,
 'The ' || event_type || ' load of user ' || CAST(user_id AS STRING) || ' failed at record '
  || CAST(event_id AS STRING) || '.' AS input,
 CASE event_type WHEN 'click' THEN 'SCHEMA_ERROR' WHEN 'view' THEN 'CONNECTION_ERROR'
  WHEN 'purchase' THEN 'DATA_QUALITY_ERROR' WHEN 'signup' THEN 'AUTHENTICATION_ERROR'
  ELSE 'TIMEOUT' END AS category,
 CASE event_id % 5 WHEN 0 THEN 'The field ' || chr(39) || event_type || chr(39) || ' is not in the target.'
  WHEN 1 THEN 'The field "' || event_type || '" isn' || chr(39) || 't in the target.'
  WHEN 2 THEN 'Path C:' || chr(92) || 'in' || chr(92) || event_type || ' could not be read.'
  WHEN 3 THEN 'First line.' || chr(10) || 'Second line:' || chr(9) || event_type || chr(13)
  ELSE 'The value of "' || event_type || '" is out of range.' END AS root_cause,
 'Fix the ' || event_type || ' mapping and rerun for user ' || CAST(user_id AS STRING) || '.' AS recommendation
FROM {events}""".replace("{instruction}", C.ANALYSIS_INSTRUCTION)

# The same as JSON lines, with every kind of fault.
EXAMPLE_LINES = """SELECT event_id AS example_id,
 '{{"example_id": ' || CAST(event_id AS STRING)
 || CASE WHEN event_id % 9 = 1 THEN '' WHEN event_id % 9 = 2 THEN ', "instruction": null'
    ELSE ', "instruction": "Analyze the failure."' END
 || CASE WHEN event_id % 9 = 1 OR event_id % 9 = 3 THEN ''
    ELSE ', "input": "The ' || event_type || ' load failed."' END
 || ', "output": '
 || CASE event_id % 9 WHEN 4 THEN '"a plain string"' WHEN 5 THEN '["a", "list"]'
    WHEN 6 THEN '{{"category": "TIMEOUT"}}' WHEN 7 THEN 'null'
    WHEN 8 THEN '{{"category": null, "recommendation": "Retry it.", "extra": 1}}'
    ELSE '{{"recommendation": "Rerun it.", "category": "TIMEOUT", "root_cause": "The '
      || event_type || ' stage was slow."}}' END
 || '}}' AS line,
 event_id % 9 AS fault, event_type
FROM {events}"""

# Log entries of training runs of fifty events each: a training entry per event,
# ten steps to an epoch, and an evaluation entry after each epoch.
LOG_ENTRIES = """SELECT run_id, step, step / 10.0 AS epoch, kind,
 step * 2 + CASE WHEN kind = 'eval' THEN 1 ELSE 0 END AS sort_key,
 CASE WHEN kind = 'train' THEN value + 1 END AS loss,
 CASE WHEN kind = 'train' THEN step * 100.0 END AS num_tokens,
 CASE WHEN kind = 'eval' THEN value / 2 + 1 END AS eval_loss,
 CASE WHEN kind = 'eval' THEN 1 / (value + 1) END AS eval_mean_token_accuracy,
 CASE WHEN kind = 'eval' THEN CAST(user_id % 4 AS DOUBLE) / 8 END AS eval_runtime
FROM (SELECT CAST(floor(event_id / 50) AS BIGINT) AS run_id, event_id % 50 + 1 AS step,
 value, user_id, @kinds@ AS kind FROM {events}) AS entries"""

# Conversations with tools: some turns become tool messages, some assistant
# turns call a tool.
TOOL_TURNS = """SELECT conv_id, turn,
 CASE WHEN turn > 0 AND length(text) % 3 = 0 THEN 'tool' ELSE role END AS role, text,
 CASE WHEN role = 'assistant' AND length(text) % 3 = 1 THEN
  CASE WHEN length(text) % 2 = 0 THEN 1 ELSE 2 END ELSE 0 END AS calls
FROM {conversations}"""

FIXTURES = {
    "eval_cases": EVAL_CASES,
    "responses": RESPONSES,
    "judge_answers": JUDGE_ANSWERS,
    "examples": EXAMPLES,
    "example_lines": EXAMPLE_LINES,
    "log_entries": LOG_ENTRIES,
    "tool_turns": TOOL_TURNS,
}
MODELS = ["base", "tuned"]
_EVALUATED = "CASE WHEN (event_id + 1) % 10 = 0"
# What becomes several rows, in either dialect.
_SPARK = {
    "@models@": "explode(array('base', 'tuned'))",
    "@kinds@": f"explode({_EVALUATED} THEN array('train', 'eval') ELSE array('train') END)",
}
_DUCKDB = {
    "@models@": "unnest(['base', 'tuned'])",
    "@kinds@": f"unnest({_EVALUATED} THEN ['train', 'eval'] ELSE ['train'] END)",
}
_TABLES = ["events", "conversations"]


def table(spark, sf_dir, name):
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _spelled(name, dialect):
    sql = FIXTURES[name]
    for mark, expression in dialect.items():
        sql = sql.replace(mark, expression)
    return sql


def fixture(spark, sf_dir, name):
    """A derived table as a DataFrame."""
    sql = _spelled(name, _SPARK)
    used = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def duckdb_ctes(*names):
    """``WITH`` clause that defines derived tables for DuckDB."""
    parts = []
    for name in names:
        sql = _spelled(name, _DUCKDB)
        for given in _TABLES:
            sql = sql.replace("{" + given + "}", given)
        sql = sql.replace("{{", "{").replace("}}", "}")
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n"
