"""SQL pieces shared by the DuckDB counterparts of the queries."""

from gradeloom import constants as C


def text(value):
    """A string as an SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def strip(expr):
    return f"trim({expr}, {text(C.WHITESPACE)})"


def canonical(expr):
    arms = " ".join(f"WHEN contains({expr}, '{c}') THEN '{c}'" for c in C.CATEGORIES)
    return f"CASE {arms} END"


def phrases(expr):
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains({expr}, '{p}')" for p in found)
        + f" THEN '{label}'"
        for label, found in C.CATEGORY_PHRASES.items()
    )
    return f"CASE {arms} END"


def section(expr, markers):
    arms = " ".join(
        f"WHEN instr(lower({expr}), '{m}') > 0 "
        f"THEN substr({expr}, instr(lower({expr}), '{m}') + {len(m)})"
        for m in markers
    )
    return f"CASE {arms} END"


_CUT = (
    "CASE WHEN instr(lower(tail), 'recommended action') > 0 "
    "THEN substr(tail, 1, instr(lower(tail), 'recommended action') - 1) ELSE tail END"
)
ANALYSED = f"""analysed AS (SELECT *,
 coalesce(length(category), 0) >= {C.MIN_CATEGORY_CHARS}
  AND length(root_cause) >= {C.MIN_ROOT_CAUSE_CHARS}
  AND length(recommendation) >= {C.MIN_RECOMMENDATION_CHARS} AS is_valid
 FROM (SELECT response_id, case_id, model, response,
  coalesce({canonical('upper(response)')}, {phrases('upper(response)')}) AS category,
  coalesce({strip(_CUT)}, '') AS root_cause,
  coalesce({strip(section('response', C.RECOMMENDATION_MARKERS))}, '') AS recommendation
 FROM (SELECT *, {section('response', C.ROOT_CAUSE_MARKERS)} AS tail FROM responses)))
"""
SCORED = """scored AS (SELECT a.*, c.input, c.expected_category, c.expected_root_cause,
 c.expected_recommendation, coalesce(a.category = c.expected_category, false) AS category_correct
 FROM analysed a JOIN eval_cases c ON a.case_id = c.case_id)
"""


def normalised(expr):
    return (
        "trim(regexp_replace(regexp_replace(regexp_replace(lower(" + expr + "), "
        "'[*#`]', ' ', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def word_list(expr):
    return f"list_filter(list_distinct(string_split({normalised(expr)}, ' ')), lambda w: w <> '')"


def overlap(expected, predicted):
    e, p = word_list(expected), word_list(predicted)
    return (
        f"CASE WHEN len({e}) = 0 THEN 0.0 ELSE "
        f"len(list_intersect({e}, {p})) / len({e}) END"
    )


def segment(role, content):
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


def lines(value):
    """A literal whose line breaks and quotes are plain SQL text."""
    return text(value)


def judge_prompt(failure, expected_cause, cause, expected_advice, advice):
    values = [failure, expected_cause, cause, expected_advice, advice]
    out = text(C.JUDGE_OPENING)
    for (heading, _), value in zip(C.JUDGE_FIELDS, values):
        out += " || " + text(f"\n\n{heading}:\n") + " || " + value
    return out + " || " + text("\n\n" + C.JUDGE_RUBRIC)


def _flag(name):
    return f"""CASE json_type(doc, '$.{name}')
  WHEN 'BOOLEAN' THEN json_extract_string(doc, '$.{name}') = 'true'
  WHEN 'VARCHAR' THEN CASE
   WHEN lower(json_extract_string(doc, '$.{name}')) IN ('true','t','yes','y','on','1') THEN true
   WHEN lower(json_extract_string(doc, '$.{name}')) IN ('false','f','no','n','off','0') THEN false END
  WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN NULL WHEN 'NULL' THEN NULL
  ELSE CASE TRY_CAST(json_extract_string(doc, '$.{name}') AS DOUBLE)
   WHEN 1 THEN true WHEN 0 THEN false END END AS {name}"""


FENCE = C.CODE_FENCE


def judge_ctes(source, column):
    """Reading of the answers in ``source.column``: unfenced, parsed, judged."""
    body = strip(column)
    opened = strip(
        f"regexp_replace(regexp_replace(body, '{FENCE}json', ''), '{FENCE}', '')"
    )
    return f"""unfenced AS (SELECT *, CASE WHEN starts_with(body, '{FENCE}')
  THEN {opened} ELSE body END AS answer
 FROM (SELECT *, {body} AS body FROM {source})),
parsed AS (SELECT *, {', '.join(_flag(f) for f in C.JUDGE_FLAGS)},
  CASE WHEN json_type(doc, '$.explanation') = 'VARCHAR'
   THEN json_extract_string(doc, '$.explanation') END AS explanation
 FROM (SELECT *, CASE WHEN starts_with(answer, '{{') AND json_valid(answer)
   THEN CAST(answer AS JSON) END AS doc FROM unfenced)),
judged AS (SELECT *, CASE WHEN is_read THEN CASE WHEN NOT root_cause_correct THEN 0
   WHEN root_cause_has_unsupported_claim THEN 1 ELSE 2 END END AS root_cause_score,
  CASE WHEN is_read THEN CASE WHEN NOT recommendation_appropriate THEN 0
   WHEN NOT recommendation_complete THEN 1 ELSE 2 END END AS recommendation_score
 FROM (SELECT *, {' AND '.join(f'{f} IS NOT NULL' for f in C.JUDGE_FLAGS)}
   AND coalesce(length(explanation), 0) >= {C.MIN_EXPLANATION_CHARS} AS is_read FROM parsed))
"""


TOKENS = (
    r"regexp_extract_all({0}, '<\|[a-z_]+\|>| ?[\p{{L}}\p{{M}}\p{{N}}_]+"
    r"|[^\p{{L}}\p{{M}}\p{{N}}_]')"
)


def tokens(expr):
    return TOKENS.format(expr)
