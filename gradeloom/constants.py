"""Fixed values.

Everything here has to hold these exact values for results to be right: label
names, phrase lists, markers, message formats and training settings.
"""

# --- fixed values: the six evaluation labels, in matching order ---------------
CATEGORIES = [
    "SCHEMA_ERROR",
    "AUTH_ERROR",
    "TIMEOUT_ERROR",
    "QUOTA_ERROR",
    "CONNECTION_ERROR",
    "DATA_ERROR",
]

# --- fixed values: phrases that stand for a label, in matching order ----------
# A phrase that contains another phrase of the same label can never decide
# anything, so only the shortest ones are listed.
CATEGORY_PHRASES = {
    "SCHEMA_ERROR": ["SCHEMA", "FIELD DOES NOT EXIST", "COLUMN DOES NOT EXIST"],
    "AUTH_ERROR": [
        "AUTHENTICATION",
        "PERMISSION ERROR",
        "PERMISSION DENIED",
        "ACCESS DENIED",
        "IAM",
        "CREDENTIAL",
    ],
    "TIMEOUT_ERROR": ["TIMEOUT", "TIME OUT", "EXECUTION TIME", "TIME LIMIT"],
    "QUOTA_ERROR": ["QUOTA", "RATE LIMIT"],
    "CONNECTION_ERROR": [
        "CONNECTION RESET",
        "DATABASE CONNECTION",
        "CONNECTION FAILURE",
        "CONNECTION ERROR",
        "NETWORK CONNECTION",
    ],
    "DATA_ERROR": [
        "DATA VALIDATION",
        "DATA TRANSFORMATION",
        "DATA ERROR",
        "INVALID DATA",
        "INVALID VALUE",
        "TYPE CONVERSION",
    ],
}

# --- fixed values: section markers, compared in lower case --------------------
# The bold form of a marker contains the plain form, so it can never be found
# first and is not listed.
ROOT_CAUSE_MARKERS = ["root cause:", "root cause"]
RECOMMENDATION_MARKERS = ["recommended action:", "recommended action"]
SECTION_STOP = "recommended action"

# --- fixed values: structure rules ---------------------------------------------
MIN_CATEGORY_CHARS = 3
MIN_ROOT_CAUSE_CHARS = 20
MIN_RECOMMENDATION_CHARS = 20
MIN_EXPLANATION_CHARS = 20

# --- fixed values: required fields ----------------------------------------------
REQUIRED_FIELDS = ["instruction", "input", "output"]
REQUIRED_OUTPUT_FIELDS = ["category", "root_cause", "recommendation"]

# --- fixed values: validation split by row position (0-based) ------------------
VALIDATION_POSITIONS = [1, 4]

# --- fixed values: chat format ---------------------------------------------------
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
GENERATION_PROMPT = "<|im_start|>assistant\n"
ANALYSIS_INSTRUCTION = (
    "Analyze the ETL pipeline failure and identify the failure category, "
    "root cause, and recommended action."
)
FAILURE_HEADING = "\n\nETL Failure:\n"
JUDGE_SYSTEM = "You grade analyses of failed data loads and accept only what the case supports."
TOOLS_INTRO = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query."
    "\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\nFor each function call, return a json object with function name and "
    "arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
)

# --- fixed values: special tokens ------------------------------------------------
SPECIAL_TOKENS = [
    "<|endoftext|>",
    "<|im_start|>",
    "<|im_end|>",
    "<|object_ref_start|>",
    "<|object_ref_end|>",
    "<|box_start|>",
    "<|box_end|>",
    "<|quad_start|>",
    "<|quad_end|>",
    "<|vision_start|>",
    "<|vision_end|>",
    "<|vision_pad|>",
    "<|image_pad|>",
    "<|video_pad|>",
]

# --- fixed values: the judge's answer --------------------------------------------
JUDGE_FLAGS = [
    "root_cause_correct",
    "root_cause_has_unsupported_claim",
    "recommendation_appropriate",
    "recommendation_complete",
]
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]
CODE_FENCE = "```"

# --- fixed values: training settings ---------------------------------------------
IGNORE_LABEL = -100
MAX_LENGTH = 256
GRADIENT_ACCUMULATION = 4
EPOCHS = 3
LEARNING_RATE = 2e-4
SHUFFLE_SEED = 42
CHECKPOINTS_KEPT = 2
TOP_K = 10
MAX_NEW_TOKENS = {"category": 120, "side_by_side": 150, "quality": 160, "judge": 200}

# --- fixed values: what the reference language treats as whitespace --------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Our own wording of the judging rubric: the five headed fields, the four
# questions and the answer format are fixed, the sentences are not.
JUDGE_FIELDS = [
    ("ETL FAILURE", "failure"),
    ("REFERENCE ROOT CAUSE", "reference_root_cause"),
    ("PREDICTED ROOT CAUSE", "predicted_root_cause"),
    ("REFERENCE RECOMMENDATION", "reference_recommendation"),
    ("PREDICTED RECOMMENDATION", "predicted_recommendation"),
]
JUDGE_OPENING = (
    "Another model analysed a failed ETL run. Grade its root cause and its "
    "recommendation against the reference answer."
)
JUDGE_RUBRIC = """Answer four questions.

root_cause_correct: does the predicted root cause name the main cause that the failure text supports?
root_cause_has_unsupported_claim: does it assert a specific cause that neither the failure text nor the reference supports?
recommendation_appropriate: would the predicted recommendation reasonably help with this failure?
recommendation_complete: does it cover the important steps of the reference recommendation?

Wording may differ freely. Grade technical meaning only.

Reply with this JSON object and nothing else:
{
  "root_cause_correct": true,
  "root_cause_has_unsupported_claim": false,
  "recommendation_appropriate": true,
  "recommendation_complete": true,
  "explanation": "Two or three sentences on the grades."
}"""
