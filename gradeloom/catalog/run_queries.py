"""Run logs and the training feed."""

from pyspark.sql import functions as F

from gradeloom.catalog.data_queries import run_logs
from gradeloom.catalog.fixtures import duckdb_ctes, fixture, table
from gradeloom.catalog.registry import query
from gradeloom.operators import runlog, training
from gradeloom.sources.staging import stage


def entries(spark, sf_dir):
    return runlog.flatten_run_log(run_logs(spark, sf_dir))


@query(
    "flatten_run_log",
    duckdb_ctes("log_entries")
    + """SELECT run_id, step, kind, round(epoch, 6) AS epoch, round(loss, 6) AS loss,
 round(eval_loss, 6) AS eval_loss FROM log_entries""",
)
def flatten_run_log(spark, sf_dir):
    return entries(spark, sf_dir).select(
        "run_id",
        "step",
        "kind",
        *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ["epoch", "loss", "eval_loss"]],
    )


@query(
    "epoch_summary",
    duckdb_ctes("log_entries")
    + """SELECT run_id, epoch, round(mean_train_loss, 6) AS mean_train_loss,
 round(eval_loss, 6) AS eval_loss, round(eval_accuracy, 6) AS eval_accuracy,
 round(eval_loss - lag(eval_loss) OVER (PARTITION BY run_id ORDER BY epoch), 6)
  AS eval_loss_change
FROM (SELECT run_id, CAST(ceil(epoch) AS BIGINT) AS epoch, avg(loss) AS mean_train_loss,
 max(eval_loss) AS eval_loss, max(eval_mean_token_accuracy) AS eval_accuracy
 FROM log_entries GROUP BY run_id, CAST(ceil(epoch) AS BIGINT)) AS e""",
)
def epoch_summary(spark, sf_dir):
    rows = runlog.epoch_summary(entries(spark, sf_dir))
    names = ["mean_train_loss", "eval_loss", "eval_accuracy", "eval_loss_change"]
    return rows.select("run_id", "epoch", *[F.round(c, 6).alias(c) for c in names])


@query(
    "retain_checkpoints",
    duckdb_ctes("log_entries")
    + """SELECT run_id, step FROM (SELECT run_id, step,
 row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS age
 FROM log_entries WHERE kind = 'eval') AS c WHERE age <= 2""",
)
def retain_checkpoints(spark, sf_dir):
    """A checkpoint is written with each evaluation."""
    saved = entries(spark, sf_dir).where("kind = 'eval'").select("run_id", "step")
    return runlog.retain_checkpoints(saved)


@query(
    "eval_throughput",
    duckdb_ctes("log_entries")
    + """SELECT run_id, step, round(CASE WHEN eval_runtime = 0 THEN NULL
 ELSE 2 / eval_runtime END, 6) AS samples_per_second
FROM log_entries WHERE kind = 'eval'""",
)
def eval_throughput(spark, sf_dir):
    rows = runlog.eval_throughput(entries(spark, sf_dir), F.lit(2.0))
    rate = F.round("samples_per_second", 6).alias("samples_per_second")
    return rows.select("run_id", "step", rate)


@query(
    "step_assignment",
    duckdb_ctes("examples")
    + """SELECT example_id, CAST(epoch AS BIGINT) AS epoch,
 CAST((epoch - 1) * ceil(n / 4.0) + ceil(place / 4.0) AS BIGINT) AS step,
 round(epoch - 1 + least(ceil(place / 4.0) * 4, n) / n, 6) AS epoch_fraction
FROM (SELECT example_id, epoch, count(*) OVER (PARTITION BY epoch) AS n, row_number() OVER (
  PARTITION BY epoch ORDER BY md5('42-' || CAST(epoch AS VARCHAR) || '-' || CAST(example_id AS VARCHAR)),
  example_id) AS place
 FROM (SELECT example_id, unnest([1, 2, 3]) AS epoch FROM examples) AS copies) AS placed""",
)
def step_assignment(spark, sf_dir):
    examples = fixture(spark, sf_dir, "examples").select("example_id")
    return training.assign_steps(examples).select(
        "example_id",
        F.col("epoch").cast("long").alias("epoch"),
        F.col("step").cast("long").alias("step"),
        F.round("epoch_fraction", 6).alias("epoch_fraction"),
    )


SHARDS = 4
_NUMBER = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"


@query(
    "shard_steps",
    duckdb_ctes("examples")[:-1]
    + f""",
dealt AS (SELECT example_id, {_NUMBER.format("'42-shard-' || CAST(example_id AS VARCHAR)")} % {SHARDS} AS shard
 FROM examples),
slots AS (SELECT example_id, shard, count(*) OVER (PARTITION BY shard) AS n,
 row_number() OVER (PARTITION BY shard ORDER BY md5('42-' || CAST(example_id AS VARCHAR)), example_id) - 1 AS slot
 FROM dealt),
drawn AS (SELECT *, {_NUMBER.format("'42-2-' || CAST(shard AS VARCHAR)")} AS d FROM slots),
placed AS (SELECT *, (slot * ([2147483647, 2147483629, 2147483587, 2147483579][d % 4 + 1] % n) + d) % n AS place
 FROM drawn)
SELECT example_id, shard, CAST(place AS BIGINT) AS place, CAST(place // 4 + 1 AS BIGINT) AS step
FROM placed WHERE shard <> 1 OR place >= 10""",
)
def shard_steps(spark, sf_dir):
    """The second epoch of a feed of four shards; one has taken ten rows of it already."""
    examples = fixture(spark, sf_dir, "examples").select("example_id")
    feed = stage(training.shard_feed(examples, SHARDS), "feed")
    done = spark.createDataFrame([(1, 10)], "shard long, position long")
    return training.epoch_feed(feed, 2, done=done).select("example_id", "shard", "place", "step")


@query(
    "running_tokens",
    """SELECT user_id AS run_id, event_id AS step, CAST(sum(length(props)) OVER (
 PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS num_tokens FROM events""",
)
def running_tokens(spark, sf_dir):
    steps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.length("props").alias("tokens"),
    )
    return training.running_tokens(steps).select("run_id", "step", "num_tokens")


@query(
    "linear_lr",
    duckdb_ctes("log_entries")
    + """SELECT run_id, step, round(2e-4 * (1 - (step - 1) / 50), 9) AS learning_rate
FROM log_entries WHERE kind = 'train'""",
)
def linear_lr(spark, sf_dir):
    logs = run_logs(spark, sf_dir)
    rows = logs.select("run_id", "max_steps", F.explode("log_history").alias("entry"))
    rate = training.linear_rate(F.col("entry.step"), F.col("max_steps"))
    return rows.where("entry.loss IS NOT NULL").select(
        "run_id", "entry.step", F.round(rate, 9).alias("learning_rate")
    )
