"""A table of model answers that a broken run can go on from.

Answers are kept under the model's name and a hash of the prompt, apart from the rows that
asked, so equal prompts are answered once and a later run asks only what is not there yet.
"""

from pyspark.sql import functions as F, types as T

from gradeloom import constants as C
from gradeloom.operators.inference import apply_model, limited

KEY = ["model", "prompt_hash"]


def prompt_hash(prompt):
    """256 bits that stand for a prompt."""
    return F.sha2(prompt.cast("binary"), 256)


def read_answers(spark, path, result_type):
    """``(model, prompt_hash, answer)`` of the store, each once; empty if there is none.

    A run that ends between two commits may leave an answer twice.
    """
    schema = T.StructType([T.StructField("prompt_hash", T.StringType())])
    schema = schema.add("answer", result_type).add("model", "string").add("part", "integer")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        rows = spark.read.schema(schema).parquet(path)
    else:
        rows = spark.createDataFrame([], schema)
    return rows.select("model", "prompt_hash", "answer").dropDuplicates(KEY)


def answer_missing(df, prompt, factory, model, path, result_type, parts=16, batch_size=32):
    """Ask the model for every prompt of ``df`` that the store has no answer to.

    The hashes are dealt into ``parts``, and each is one job that commits its answers; a
    run that is broken off loses the answers of one part at most. Null prompts are not
    asked.
    """
    spark = df.sparkSession
    asked = df.where(F.col(prompt).isNotNull()).select(
        prompt_hash(F.col(prompt)).alias("prompt_hash"), F.col(prompt).alias("prompt")
    )
    part = (F.conv(F.substring("prompt_hash", 1, 8), 16, 10).cast("long") % parts).cast("int")
    for number in range(parts):
        own = asked.where(part == number).groupBy("prompt_hash").agg(F.any_value("prompt").alias("prompt"))
        known = read_answers(spark, path, result_type).where(F.col("model") == model).select("prompt_hash")
        left = own.join(known, "prompt_hash", "left_anti")
        made = apply_model(left, "prompt", factory, "answer", result_type, batch_size)
        made = made.select("prompt_hash", "answer", F.lit(model).alias("model"), F.lit(number).alias("part"))
        made.write.mode("append").partitionBy("model", "part").parquet(path)


def with_answers(df, prompt, model, path, name, result_type):
    """Add the stored answers; a prompt without one gets null.

    Only the hash and the answer are joined, and a prompt that very many rows share can be
    split there.
    """
    answers = read_answers(df.sparkSession, path, result_type).where(F.col("model") == model)
    answers = answers.select(F.col("prompt_hash").alias("_hash"), F.col("answer").alias(name))
    rows = df.withColumn("_hash", prompt_hash(F.col(prompt)))
    return rows.join(answers, "_hash", "left").drop("_hash")


def generate_stored(
    df,
    prompt,
    factory,
    model,
    path,
    name="response",
    max_new_tokens=C.MAX_NEW_TOKENS["quality"],
    batch_size=32,
    parts=16,
):
    """As :func:`generate`, with the answers kept in the store at ``path``.

    ``model`` names what answers, its settings included: prompts that it has answered
    before are not generated again.
    """
    load = limited(factory, max_new_tokens)
    answer_missing(df, prompt, load, model, path, T.StringType(), parts, batch_size)
    return with_answers(df, prompt, model, path, name, T.StringType())


def embed_stored(df, text, factory, model, path, name="embedding", batch_size=256, parts=16):
    """As :func:`embed`, with the vectors kept in the store at ``path``."""
    vector = T.ArrayType(T.FloatType())
    answer_missing(df, text, factory, model, path, vector, parts, batch_size)
    return with_answers(df, text, model, path, name, vector)
