"""Readers. Schemas are explicit: inference would sort the fields by name."""

from pyspark.sql import functions as F

from gradeloom.sources.arrays import read_array_elements

OUTPUT = "struct<category:string,root_cause:string,recommendation:string>"
# `output` is read as a variant, so that one element with a wrong shape spoils
# only its own row and the validator can still see what was there.
EXAMPLE_FILE = "example_id long, instruction string, input string, output variant"
CASE_FILE = (
    "case_id long, input string, expected_category string, "
    "expected_root_cause string, expected_recommendation string"
)
LOG_ENTRY = (
    "struct<step:long,epoch:double,loss:double,learning_rate:double,grad_norm:double,"
    "entropy:double,mean_token_accuracy:double,num_tokens:double,"
    "eval_loss:double,eval_entropy:double,eval_mean_token_accuracy:double,"
    "eval_num_tokens:double,eval_runtime:double,eval_samples_per_second:double,"
    "eval_steps_per_second:double>"
)
RUN_LOG_FILE = (
    "run_id long, epoch double, global_step long, max_steps long, logging_steps long, "
    "num_train_epochs long, save_steps long, train_batch_size long, "
    "best_global_step long, best_metric double, best_model_checkpoint string, "
    f"total_flos double, log_history array<{LOG_ENTRY}>"
)


def read_table(spark, path):
    """A Parquet table."""
    return spark.read.parquet(path)


def _elements(spark, path, schema):
    """Elements of the JSON arrays in ``path`` with their 0-based place in the file."""
    fields = [field.split(" ", 1) for field in schema.split(", ")]
    element = F.parse_json("element")
    rows = read_array_elements(spark, path).select(F.col("place").alias("_place"), element.alias("_element"))
    named = [F.try_variant_get("_element", f"$.{name}", kind).alias(name) for name, kind in fields]
    return rows.select("_place", *named)


def _keyed_rows(spark, path, schema, key, multi_line):
    """Rows with a key: that of the element, or in an array its place.

    A row of JSON Lines has no place that survives a split, so it must have a key.
    """
    if multi_line:
        rows = _elements(spark, path, schema)
        return rows.withColumn(key, F.coalesce(key, "_place")).drop("_place")
    rows = spark.read.schema(schema).json(path)
    missing = F.raise_error(F.lit(f"a line has no {key}")).cast("long")
    return rows.withColumn(key, F.when(F.col(key).isNull(), missing).otherwise(F.col(key)))


def read_examples(spark, path, multi_line=False):
    """Training examples: ``(example_id, instruction, input, output_raw, output)``.

    ``multi_line=True`` reads pretty-printed JSON arrays; elements without an id get
    their place in the array, from 0.
    """
    rows = _keyed_rows(spark, path, EXAMPLE_FILE, "example_id", multi_line)
    return rows.select(
        "example_id",
        "instruction",
        "input",
        F.col("output").alias("output_raw"),
        F.try_variant_get("output", "$", OUTPUT).alias("output"),
    )


def read_eval_cases(spark, path, multi_line=False):
    """Held-out cases: the failure text and the three expected answers.

    Cases of a JSON array without an id get their place in it, from 0.
    """
    return _keyed_rows(spark, path, CASE_FILE, "case_id", multi_line)


def read_run_log(spark, path, multi_line=False):
    """Training run logs, one row per run, with the file each came from.

    Trainers write a file per run and no id; the run is then named by a hash of the
    file's path.
    """
    rows = spark.read.schema(RUN_LOG_FILE).json(path, multiLine=multi_line)
    rows = rows.withColumn("source_file", F.input_file_name())
    return rows.withColumn("run_id", F.coalesce("run_id", F.xxhash64("source_file")))
