"""Training examples to prompts and completions."""

from pyspark.sql import functions as F

from gradeloom.functions import chat


def prompt_completion(examples, as_json=False):
    """``(example_id, prompt, completion)``, two message arrays per example."""
    text = chat.completion_text(F.col("output"), as_json)
    return examples.select(
        "example_id",
        chat.prompt_messages(F.col("instruction"), F.col("input")).alias("prompt"),
        F.array(chat.message("assistant", text)).alias("completion"),
    )


def training_text(pairs):
    """Prompt and completion rendered as the one text a model is trained on."""
    return pairs.withColumn("rendered", chat.render(F.concat("prompt", "completion")))
