"""Judge answers to scores."""

from pyspark.sql import functions as F

from gradeloom.functions import judge
from gradeloom.functions.text import strip


def parse_judge(df, response="judge_response"):
    """Add ``judge_result``, null unless the answer is valid as a whole."""
    return (
        df.withColumn("_body", strip(F.col(response)))
        .withColumn("_answer", judge.unfence(F.col("_body")))
        .withColumn("_wrapped", judge.wrap(F.col("_answer")))
        .withColumn("_parsed", judge.read_wrapped(F.col("_wrapped")))
        .withColumn(
            "_fields",
            F.when(
                judge.is_complete(F.col("_answer"), F.col("_wrapped"), F.col("_parsed")),
                judge.fields(F.col("_parsed")),
            ),
        )
        .withColumn("judge_result", judge.validated(F.col("_fields")))
        .drop("_body", "_answer", "_wrapped", "_parsed", "_fields")
    )


def judge_scores(df, result="judge_result"):
    """Add both scores, 0 to 2, null where the answer could not be read."""
    return df.withColumns(
        {
            "root_cause_score": judge.root_cause_score(F.col(result)),
            "recommendation_score": judge.recommendation_score(F.col(result)),
        }
    )
