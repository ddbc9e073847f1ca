"""Training run logs."""

from pyspark.sql import Window, functions as F

from gradeloom import constants as C


def flatten_run_log(logs):
    """One row per log entry; entries with an evaluation loss are ``eval``."""
    source = [c for c in ("source_file",) if c in logs.columns]
    entries = logs.select("run_id", *source, F.explode("log_history").alias("entry"))
    kind = F.when(F.col("entry.eval_loss").isNotNull(), "eval").otherwise("train")
    return entries.select("run_id", *source, kind.alias("kind"), "entry.*")


def epoch_summary(entries):
    """Per run and epoch: mean training loss, evaluation loss and accuracy, and
    the change of the evaluation loss since the epoch before.

    An evaluation row counts for its own epoch and, as the value before, for the
    next one, so that one grouping on both keys answers all of it.
    """
    own = F.ceil("epoch").cast("long")
    is_eval = F.col("kind") == "eval"
    epochs = F.when(is_eval, F.array(own, own + 1)).otherwise(F.array(own))
    rows = entries.withColumn("_own", own).withColumn("epoch", F.explode(epochs))
    current = F.col("_own") == F.col("epoch")

    def last_eval(column, condition):
        return F.max_by(F.when(condition & is_eval, F.col(column)),
                        F.when(condition & is_eval, F.col("step")))

    previous = last_eval("eval_loss", ~current)
    return (
        rows.groupBy("run_id", "epoch")
        .agg(
            F.max(current).alias("_logged"),
            F.avg(F.when(current & ~is_eval, F.col("loss"))).alias("mean_train_loss"),
            last_eval("eval_loss", current).alias("eval_loss"),
            last_eval("eval_mean_token_accuracy", current).alias("eval_accuracy"),
            previous.alias("_previous"),
        )
        .where("_logged")
        .withColumn("eval_loss_change", F.col("eval_loss") - F.col("_previous"))
        .drop("_logged", "_previous")
    )


def retain_checkpoints(checkpoints, kept=C.CHECKPOINTS_KEPT):
    """The newest checkpoints of each run."""
    newest = Window.partitionBy("run_id").orderBy(F.desc("step"))
    return (
        checkpoints.withColumn("age", F.row_number().over(newest))
        .where(F.col("age") <= kept)
        .drop("age")
    )


def eval_throughput(entries, samples):
    """Evaluation rows with samples per second, null for a run time of zero."""
    rate = F.try_divide(samples, F.col("eval_runtime"))
    return entries.where(F.col("kind") == "eval").withColumn("samples_per_second", rate)
