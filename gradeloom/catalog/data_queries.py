"""Reading, validation, description and splits of training data."""

from pyspark.sql import functions as F

from gradeloom.catalog.fixtures import duckdb_ctes, fixture, table
from gradeloom.catalog.registry import query
from gradeloom.catalog.sql import ANALYSED
from gradeloom.functions.tokens import tokenize
from gradeloom.operators import profile, quality, responses, splits
from gradeloom.sources import readers, writers
from gradeloom.sources.staging import staging_path


def written_examples(spark, sf_dir):
    """The example lines written as JSON Lines and read back by the reader."""
    path = staging_path(spark, "example-lines")
    fixture(spark, sf_dir, "example_lines").select("line").write.text(path)
    return readers.read_examples(spark, path)


def valid_examples(spark, sf_dir):
    """Examples with their output as a record."""
    fields = ["category", "root_cause", "recommendation"]
    return fixture(spark, sf_dir, "examples").select(
        "example_id", "instruction", "input", F.struct(*fields).alias("output")
    )


@query(
    "scan_examples",
    duckdb_ctes("example_lines")
    + """SELECT example_id,
 CASE WHEN fault IN (1, 2) THEN NULL ELSE 'Analyze the failure.' END AS instruction,
 CASE WHEN fault IN (1, 3) THEN NULL ELSE 'The ' || event_type || ' load failed.' END AS input,
 CASE WHEN fault IN (0, 1, 2, 3, 6) THEN 'TIMEOUT' END AS category,
 CASE WHEN fault IN (0, 1, 2, 3) THEN 'The ' || event_type || ' stage was slow.' END AS root_cause,
 CASE WHEN fault IN (0, 1, 2, 3) THEN 'Rerun it.' WHEN fault = 8 THEN 'Retry it.' END AS recommendation
FROM example_lines""",
)
def scan_examples(spark, sf_dir):
    return written_examples(spark, sf_dir).select(
        "example_id", "instruction", "input", "output.*"
    )


@query("scan_eval_cases", duckdb_ctes("eval_cases") + "SELECT * FROM eval_cases")
def scan_eval_cases(spark, sf_dir):
    path = staging_path(spark, "eval-cases")
    writers.write_json_lines(fixture(spark, sf_dir, "eval_cases"), path)
    return readers.read_eval_cases(spark, path)


def run_logs(spark, sf_dir):
    """One row per run; a run has 55 entries, so a log is a small array."""
    entries = fixture(spark, sf_dir, "log_entries")
    fields = ["step", "epoch", "loss", "num_tokens", "eval_loss"]
    fields += ["eval_mean_token_accuracy", "eval_runtime"]
    log = F.sort_array(F.collect_list(F.struct("sort_key", *fields)))
    without_key = F.transform(log, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return entries.groupBy("run_id").agg(
        F.max("step").alias("global_step"),
        F.max("step").alias("max_steps"),
        without_key.alias("log_history"),
    )


def written_run_logs(spark, sf_dir):
    path = staging_path(spark, "run-logs")
    writers.write_json_lines(run_logs(spark, sf_dir), path)
    return readers.read_run_log(spark, path)


@query(
    "scan_run_log",
    duckdb_ctes("log_entries")
    + """SELECT run_id, max(step) AS global_step, max(step) AS max_steps,
 count(*) AS entries, count(eval_loss) AS eval_entries, round(sum(loss), 6) AS total_loss
FROM log_entries GROUP BY run_id""",
)
def scan_run_log(spark, sf_dir):
    logs = written_run_logs(spark, sf_dir)
    losses = F.transform("log_history", lambda e: F.coalesce(e["loss"], F.lit(0.0)))
    evals = F.filter("log_history", lambda e: e["eval_loss"].isNotNull())
    total = F.aggregate(losses, F.lit(0.0), lambda acc, x: acc + x)
    return logs.select(
        "run_id",
        "global_step",
        "max_steps",
        F.size("log_history").cast("long").alias("entries"),
        F.size(evals).cast("long").alias("eval_entries"),
        F.round(total, 6).alias("total_loss"),
    )


_HASH_SPLIT = (
    "CASE WHEN substr(md5(CAST({key} AS VARCHAR)), 1, 8) < '33333333' "
    "THEN 'validation' ELSE 'train' END AS split"
)


@query(
    "write_splits",
    duckdb_ctes("examples")
    + f"SELECT example_id, category, {_HASH_SPLIT.format(key='example_id')} FROM examples",
)
def write_splits(spark, sf_dir):
    path = staging_path(spark, "splits")
    rows = fixture(spark, sf_dir, "examples").select("example_id", "category")
    writers.write_splits(splits.split_by_hash(rows), path)
    return spark.read.parquet(path)


_ERRORS = """SELECT example_id, CASE fault WHEN 1 THEN 'missing fields: instruction, input'
 WHEN 2 THEN 'missing fields: instruction' WHEN 3 THEN 'missing fields: input'
 WHEN 4 THEN 'output has to be an object' WHEN 5 THEN 'output has to be an object'
 WHEN 6 THEN 'missing output fields: root_cause, recommendation'
 WHEN 7 THEN 'missing fields: output'
 WHEN 8 THEN 'missing output fields: category, root_cause' ELSE '' END AS errors
FROM example_lines"""


@query("validate_examples", duckdb_ctes("example_lines") + _ERRORS)
def validate_examples(spark, sf_dir):
    checked = quality.validate_examples(written_examples(spark, sf_dir))
    return checked.select("example_id", F.array_join("errors", "; ").alias("errors"))


@query(
    "validation_report",
    duckdb_ctes("example_lines")
    + f"""SELECT errors AS error, count(*) AS examples FROM ({_ERRORS}) AS e
 WHERE errors <> '' GROUP BY errors""",
)
def validation_report(spark, sf_dir):
    checked = quality.validate_examples(written_examples(spark, sf_dir))
    return quality.validation_report(checked)


@query(
    "structure_valid",
    duckdb_ctes("responses")[:-1] + ",\n" + ANALYSED
    + "SELECT response_id, is_valid FROM analysed",
)
def structure_valid(spark, sf_dir):
    rows = responses.extract_analysis(fixture(spark, sf_dir, "responses"))
    return quality.add_structure_validity(rows).select("response_id", "is_valid")


@query(
    "dataset_summary",
    duckdb_ctes("examples")
    + """SELECT count(*) AS num_rows,
 'example_id, instruction, input, category' AS column_names,
 min_by('{"example_id":' || CAST(example_id AS VARCHAR) || ',"instruction":"' || instruction
  || '","input":"' || input || '","category":"' || category || '"}', example_id) AS first_row
FROM examples""",
)
def dataset_summary(spark, sf_dir):
    columns = ["example_id", "instruction", "input", "category"]
    return profile.dataset_summary(fixture(spark, sf_dir, "examples").select(*columns))


@query(
    "category_listing",
    duckdb_ctes("examples")
    + "SELECT row_number() OVER (ORDER BY example_id) AS number, category FROM examples",
)
def category_listing(spark, sf_dir):
    return profile.category_listing(fixture(spark, sf_dir, "examples"))


@query(
    "category_distribution",
    duckdb_ctes("examples")
    + "SELECT category, count(*) AS examples FROM examples GROUP BY category",
)
def category_distribution(spark, sf_dir):
    return profile.category_distribution(fixture(spark, sf_dir, "examples"))


@query(
    "split_by_position",
    duckdb_ctes("examples")
    + """SELECT example_id, CASE WHEN row_number() OVER (ORDER BY example_id) - 1 IN (1, 4)
 THEN 'validation' ELSE 'train' END AS split FROM examples""",
)
def split_by_position(spark, sf_dir):
    rows = fixture(spark, sf_dir, "examples")
    return splits.split_by_position(rows).select("example_id", "split")


@query(
    "split_by_hash",
    f"SELECT doc_id, {_HASH_SPLIT.format(key='doc_id')} FROM documents",
)
def split_by_hash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return splits.split_by_hash(documents, "doc_id").select("doc_id", "split")


_WORDS = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"


@query(
    "token_word_ratio",
    f"""SELECT doc_id, word_count, token_count,
 round(CASE WHEN word_count = 0 THEN NULL ELSE token_count / word_count END, 6)
  AS token_word_ratio
FROM (SELECT doc_id, {_WORDS} AS word_count,
 len(regexp_extract_all(text, '<\\|[a-z_]+\\|>| ?[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]'))
  AS token_count FROM documents) AS counted""",
)
def token_word_ratio(spark, sf_dir):
    rows = profile.token_word_ratio(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("word_count").cast("long").alias("word_count"),
        F.col("token_count").cast("long").alias("token_count"),
        F.round("token_word_ratio", 6).alias("token_word_ratio"),
    )
