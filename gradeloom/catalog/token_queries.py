"""Tokens, vocabularies, loss masks and probabilities."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.catalog import sql as S
from gradeloom.catalog.chat_queries import _DEFAULT, _HEADING, _RECORD, _RENDERED
from gradeloom.catalog.data_queries import _HASH_SPLIT, valid_examples
from gradeloom.catalog.fixtures import duckdb_ctes, table
from gradeloom.catalog.registry import query
from gradeloom.functions import tokens as T
from gradeloom.operators import (
    conversations,
    masking,
    probability,
    profile,
    vocabulary as V,
)
from gradeloom.plans import preparation
from gradeloom.sources.staging import stage


def document_tokens(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", T.tokenize(F.col("text")).alias("tokens"))


def conversation_tokens(spark, sf_dir):
    """Tokens of every rendered conversation."""
    turns = table(spark, sf_dir, "conversations")
    rendered = conversations.render_conversations(turns)
    return rendered.select(
        F.col("conv_id").alias("seq_id"), "rendered", T.tokenize(F.col("rendered")).alias("tokens")
    )


def digest(array):
    """A whole array as one short value to compare."""
    return F.md5(F.array_join(F.transform(array, lambda x: x.cast("string")), "|"))


@query(
    "tokenize",
    f"""SELECT doc_id, len(tokens) AS token_count, md5(array_to_string(tokens, '|')) AS tokens
FROM (SELECT doc_id, {S.tokens('text')} AS tokens FROM documents) AS t""",
)
def tokenize(spark, sf_dir):
    return document_tokens(spark, sf_dir).select(
        "doc_id",
        F.size("tokens").cast("long").alias("token_count"),
        digest("tokens").alias("tokens"),
    )


_VOCABULARY = """vocabulary AS (SELECT token, count(*) AS "count",
 row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS id
 FROM (SELECT unnest(tokens) AS token FROM sequences) AS u GROUP BY token)"""
_DOCUMENTS = (
    f"WITH sequences AS (SELECT doc_id AS seq_id, {S.tokens('text')} AS tokens FROM documents),\n"
    + _VOCABULARY
)
_CONVERSATIONS = (
    f"""WITH rendered AS ({_RENDERED}),
sequences AS (SELECT conv_id AS seq_id, rendered,
 {S.tokens('rendered')} AS tokens FROM rendered),
"""
    + _VOCABULARY
)
_ENCODED = """,
placed AS (SELECT seq_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos
 FROM sequences),
encoded AS (SELECT p.seq_id, list(v.id ORDER BY p.pos) AS ids
 FROM placed p JOIN vocabulary v ON p.token = v.token GROUP BY p.seq_id)
"""


@query("vocabulary", _DOCUMENTS + ' SELECT token, id, "count" FROM vocabulary')
def vocabulary(spark, sf_dir):
    words = V.build_vocabulary(document_tokens(spark, sf_dir))
    return words.select("token", F.col("id").cast("long").alias("id"), "count")


@query(
    "encode",
    _DOCUMENTS
    + _ENCODED
    + """SELECT seq_id AS doc_id, len(ids) AS token_count, md5(array_to_string(ids, '|')) AS ids
FROM encoded""",
)
def encode(spark, sf_dir):
    rows = V.slice_items(document_tokens(spark, sf_dir), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    return V.encode(rows, words).select(
        "doc_id", F.size("ids").cast("long").alias("token_count"), digest("ids").alias("ids")
    )


@query("decode", "SELECT doc_id, md5(text) AS decoded FROM documents")
def decode(spark, sf_dir):
    """Encoding a text and decoding the ids gives the text back."""
    rows = V.slice_items(document_tokens(spark, sf_dir), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    ids = V.encode_slices(rows, words)
    decoded = V.decode(ids, words)
    return decoded.select("doc_id", F.md5("decoded").alias("decoded"))


@query(
    "decode_without_special",
    f"""WITH rendered AS ({_RENDERED})
SELECT conv_id AS seq_id,
 regexp_replace(rendered, '<\\|im_(start|end)\\|>', '', 'g') AS decoded FROM rendered""",
)
def decode_without_special(spark, sf_dir):
    rows = V.slice_items(conversation_tokens(spark, sf_dir).drop("rendered"), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    ids = V.encode_slices(rows, words)
    decoded = V.decode(ids, words, skip_special_tokens=True)
    return decoded.select("seq_id", "decoded")


@query("decode_rare_tokens", "SELECT doc_id, md5(text) AS decoded FROM documents")
def decode_rare_tokens(spark, sf_dir):
    """As ``decode`` with a lookup so small that nearly all tokens come by the join."""
    rows = V.slice_items(document_tokens(spark, sf_dir), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    ids = V.encode_slices(rows, words, max_tokens=50)
    decoded = V.decode(ids, words, max_tokens=50)
    return decoded.select("doc_id", F.md5("decoded").alias("decoded"))


_TERMS = f"""WITH sequences AS (SELECT p_partkey AS seq_id, p_name || '/' || p_brand AS term,
 {S.tokens("p_name || '/' || p_brand")} AS tokens FROM part),
"""


@query(
    "term_tokens",
    _TERMS
    + _VOCABULARY
    + _ENCODED
    + """SELECT seq_id AS p_partkey, term, array_to_string(tokens, '|') AS tokens,
 array_to_string(ids, '|') AS ids, len(ids) AS token_count
FROM sequences JOIN encoded USING (seq_id)""",
)
def term_tokens(spark, sf_dir):
    term = F.concat_ws("/", "p_name", "p_brand")
    terms = table(spark, sf_dir, "part").select(
        "p_partkey", term.alias("term"), T.tokenize(term).alias("tokens")
    )
    sliced = V.slice_items(terms)
    words = stage(V.build_vocabulary(sliced), "vocabulary")
    return V.encode(sliced, words).select(
        "p_partkey",
        "term",
        F.array_join("tokens", "|").alias("tokens"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), "|").alias("ids"),
        F.size("ids").cast("long").alias("token_count"),
    )


_MASKED = (
    _CONVERSATIONS
    + _ENCODED[:-1]
    + """,
markers AS (SELECT seq_id, max(CASE WHEN a = '<|im_start|>' AND b = 'assistant' AND c = chr(10)
  THEN pos + 2 END) AS start
 FROM (SELECT seq_id, pos, token AS a, lead(token, 1) OVER w AS b, lead(token, 2) OVER w AS c
  FROM placed WINDOW w AS (PARTITION BY seq_id ORDER BY pos)) AS m GROUP BY seq_id),
masked AS (SELECT e.seq_id, e.ids, m.start,
 CASE WHEN m.start IS NOT NULL
  THEN list_transform(e.ids, lambda x, i: CASE WHEN i <= m.start THEN -100 ELSE x END) END AS labels
 FROM encoded e JOIN markers m ON e.seq_id = m.seq_id)
"""
)


def masked_conversations(spark, sf_dir):
    rows = V.slice_items(conversation_tokens(spark, sf_dir).drop("rendered"), keep=False)
    words = stage(V.build_vocabulary(rows), "vocabulary")
    encoded = V.encode(rows, words)
    return masking.add_loss_mask(encoded, preparation.marker_ids(words))


@query(
    "loss_mask",
    _MASKED
    + """SELECT seq_id, start IS NOT NULL AS has_answer, start AS answer_start,
 md5(array_to_string(labels, '|')) AS labels FROM masked""",
)
def loss_mask(spark, sf_dir):
    return masked_conversations(spark, sf_dir).select(
        "seq_id",
        "has_answer",
        F.col("answer_start").cast("long").alias("answer_start"),
        digest("labels").alias("labels"),
    )


@query(
    "seq_length_stats",
    _MASKED
    + """SELECT count(*) AS sequences, CAST(count(*) FILTER (WHERE start IS NULL) AS BIGINT)
  AS without_answer, min(len(ids)) AS min_tokens,
 round(avg(len(ids)), 6) AS avg_tokens, max(len(ids)) AS max_tokens,
 quantile_disc(len(ids), 0.5) AS p50_tokens, quantile_disc(len(ids), 0.95) AS p95_tokens,
 quantile_disc(len(ids), 0.99) AS p99_tokens,
 CAST(sum(coalesce(start, len(ids))) AS BIGINT) AS ignored_tokens,
 CAST(sum(len(ids) - coalesce(start, len(ids))) AS BIGINT) AS supervised_tokens
FROM masked""",
)
def seq_length_stats(spark, sf_dir):
    masked = masked_conversations(spark, sf_dir)
    stats = profile.sequence_length_stats(profile.sequence_lengths(masked))
    return stats.select(
        "sequences",
        "without_answer",
        F.col("min_tokens").cast("long").alias("min_tokens"),
        F.round("avg_tokens", 6).alias("avg_tokens"),
        F.col("max_tokens").cast("long").alias("max_tokens"),
        "p50_tokens",
        "p95_tokens",
        "p99_tokens",
        "ignored_tokens",
        "supervised_tokens",
    )


@query(
    "completion_slice",
    f"""WITH rendered AS ({_RENDERED})
SELECT conv_id, len({S.tokens("rendered || lower(rendered)")})
  - len({S.tokens('rendered')}) AS new_tokens,
 md5(array_to_string({S.tokens('lower(rendered)')}, '|')) AS completion FROM rendered""",
)
def completion_slice(spark, sf_dir):
    """A model's output repeats its input first; here its answer is the input in
    lower case."""
    turns = table(spark, sf_dir, "conversations")
    rows = conversations.render_conversations(turns).select(
        "conv_id",
        T.tokenize(F.col("rendered")).alias("input"),
        T.tokenize(F.concat("rendered", F.lower("rendered"))).alias("output"),
    )
    answer = T.completion_slice(F.col("output"), F.col("input"))
    return rows.withColumn("answer", answer).select(
        "conv_id",
        F.size("answer").cast("long").alias("new_tokens"),
        digest("answer").alias("completion"),
    )


@query(
    "truncate_max_length",
    f"""SELECT doc_id, least(len(tokens), 256) AS token_count,
 md5(array_to_string(tokens[1:256], '|')) AS tokens
FROM (SELECT doc_id, {S.tokens('text')} AS tokens FROM documents) AS t""",
)
def truncate_max_length(spark, sf_dir):
    rows = document_tokens(spark, sf_dir)
    rows = rows.withColumn("tokens", T.truncate(F.col("tokens")))
    return rows.select(
        "doc_id",
        F.size("tokens").cast("long").alias("token_count"),
        digest("tokens").alias("tokens"),
    )


_PREFIX = (
    S.segment("'system'", _DEFAULT)
    + " || "
    + S.segment("'user'", f"instruction || {_HEADING} || input")
    + " || '<|im_start|>assistant' || chr(10)"
)


@query(
    "training_table",
    duckdb_ctes("examples")
    + f"""SELECT example_id, {_HASH_SPLIT.format(key='example_id')},
 least(len({S.tokens(f"{_PREFIX} || {_RECORD} || '<|im_end|>' || chr(10)")}), 256) AS token_count,
 least(len({S.tokens(_PREFIX)}), 256) AS ignored_count FROM examples""",
)
def training_table(spark, sf_dir):
    rows = preparation.training_table(valid_examples(spark, sf_dir), C.MAX_LENGTH)
    return rows.select(
        "example_id",
        "split",
        F.size("ids").cast("long").alias("token_count"),
        T.ignored_count(F.col("labels")).cast("long").alias("ignored_count"),
    )


def logits(spark, sf_dir, scale=1):
    """The vectors of ``embeddings`` as logits, their label as the target."""
    rows = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    return rows.select("vec_id", scaled.alias("logits"), F.col("label").alias("target_id"))


_SOFTMAX = """WITH logits AS (SELECT vec_id, label AS target_id,
 unnest(embedding)::DOUBLE * {scale} AS logit,
 generate_subscripts(embedding, 1) - 1 AS candidate_id FROM embeddings),
weights AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS w FROM logits),
softmax AS (SELECT *, w / sum(w) OVER (PARTITION BY vec_id) AS probability FROM weights)
"""


@query(
    "softmax",
    _SOFTMAX.format(scale=1)
    + "SELECT vec_id, candidate_id, round(probability, 6) AS probability FROM softmax",
)
def softmax(spark, sf_dir):
    rows = probability.add_probabilities(logits(spark, sf_dir))
    flat = rows.select(
        "vec_id", F.posexplode_outer("probabilities").alias("candidate_id", "probability")
    )
    return flat.select(
        "vec_id",
        F.col("candidate_id").cast("long").alias("candidate_id"),
        F.round("probability", 6).alias("probability"),
    )


def long_logits(spark, sf_dir):
    rows = logits(spark, sf_dir)
    return rows.select(
        F.col("vec_id").alias("group_id"),
        F.posexplode_outer("logits").alias("candidate_id", "logit"),
    )


@query(
    "softmax_long",
    _SOFTMAX.format(scale=1)
    + """SELECT vec_id AS group_id, candidate_id, round(probability, 6) AS probability
FROM softmax""",
)
def softmax_long(spark, sf_dir):
    rows = probability.softmax_long(long_logits(spark, sf_dir))
    return rows.select(
        "group_id",
        F.col("candidate_id").cast("long").alias("candidate_id"),
        F.round("probability", 6).alias("probability"),
    )


@query(
    "softmax_masked",
    """WITH logits AS (SELECT vec_id, unnest(embedding)::DOUBLE AS logit,
 generate_subscripts(embedding, 1) - 1 AS candidate_id FROM embeddings),
weights AS (SELECT *, CASE WHEN candidate_id >= 16 THEN 0.0 ELSE exp(logit) END AS w FROM logits)
SELECT vec_id AS group_id, candidate_id,
 round(w / sum(w) OVER (PARTITION BY vec_id), 6) AS probability FROM weights""",
)
def softmax_masked(spark, sf_dir):
    """Candidates from 16 on are masked, and so are whole slices of a group."""
    masked = F.when(F.col("candidate_id") >= 16, float("-inf")).otherwise(F.col("logit"))
    rows = long_logits(spark, sf_dir).withColumn("logit", masked)
    rows = probability.softmax_long(rows, slice_size=8)
    return rows.select(
        "group_id",
        F.col("candidate_id").cast("long").alias("candidate_id"),
        F.round("probability", 6).alias("probability"),
    )


_TOP = (
    _SOFTMAX.format(scale=1)
    + """SELECT vec_id AS {key}, rank, candidate_id, round(probability, 6) AS probability
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id
 ORDER BY probability DESC, candidate_id) AS rank FROM softmax) AS r WHERE rank <= 10"""
)


def _top(rows, key):
    return rows.select(
        key,
        F.col("rank").cast("long").alias("rank"),
        F.col("candidate_id").cast("long").alias("candidate_id"),
        F.round("probability", 6).alias("probability"),
    )


@query("top_k", _TOP.replace("{key}", "vec_id"))
def top_k(spark, sf_dir):
    rows = probability.add_probabilities(logits(spark, sf_dir))
    return _top(probability.top_k(rows, "vec_id"), "vec_id")


@query("top_k_long", _TOP.replace("{key}", "group_id"))
def top_k_long(spark, sf_dir):
    rows = probability.softmax_long(long_logits(spark, sf_dir))
    return _top(probability.top_k_long(rows), "group_id")


_TARGET = """SELECT vec_id, round(probability, 6) AS target_probability,
 round(-ln(probability), 6) AS target_nll FROM softmax WHERE candidate_id = target_id"""


def _losses(spark, sf_dir, scale=1):
    return probability.target_nll(
        probability.add_probabilities(logits(spark, sf_dir, scale))
    )


@query("target_nll", _SOFTMAX.format(scale=1) + _TARGET)
def target_nll(spark, sf_dir):
    return _losses(spark, sf_dir).select(
        "vec_id",
        F.round("target_probability", 6).alias("target_probability"),
        F.round("target_nll", 6).alias("target_nll"),
    )


_BASE_AND_TUNED = """WITH logits AS (SELECT vec_id, label AS target_id, scale,
 unnest(embedding)::DOUBLE * scale AS logit,
 generate_subscripts(embedding, 1) - 1 AS candidate_id
 FROM (SELECT *, unnest([1, 3]) AS scale FROM embeddings) AS scaled),
weights AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY vec_id, scale)) AS w FROM logits),
softmax AS (SELECT *, w / sum(w) OVER (PARTITION BY vec_id, scale) AS p FROM weights),
target AS (SELECT vec_id, max(p) FILTER (WHERE scale = 1) AS base,
 max(p) FILTER (WHERE scale = 3) AS tuned FROM softmax WHERE candidate_id = target_id GROUP BY vec_id)
SELECT vec_id, round(base, 6) AS base_target_probability, round(-ln(base), 6) AS base_target_nll,
 round(tuned, 6) AS tuned_target_probability, round(-ln(tuned), 6) AS tuned_target_nll,
 round(tuned - base, 6) AS probability_change, round(-ln(tuned) + ln(base), 6) AS nll_change
FROM target"""


@query("probability_shift", _BASE_AND_TUNED)
def probability_shift(spark, sf_dir):
    """The tuned model's logits are three times as sharp."""
    rows = probability.probability_shift(
        _losses(spark, sf_dir), _losses(spark, sf_dir, 3), "vec_id"
    )
    names = [c for c in rows.columns if c != "vec_id"]
    return rows.select("vec_id", *[F.round(c, 6).alias(c) for c in names])
