"""The training feed: which example is used in which optimizer step."""

from pyspark.sql import functions as F

from gradeloom import constants as C
from gradeloom.operators.ordering import number_by_hash, running_sum


def assign_steps(
    examples,
    key="example_id",
    epochs=C.EPOCHS,
    accumulation=C.GRADIENT_ACCUMULATION,
    seed=C.SHUFFLE_SEED,
):
    """One row per example and epoch with its optimizer ``step``.

    Each epoch has its own order, given by a hash of seed, epoch and key. The
    last step of an epoch may be short. ``epoch_fraction`` is how far the run has
    come when the step is done.
    """
    copies = examples.withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))
    ).withColumn(
        "_hash",
        F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"),
                          F.col(key).cast("string"))),
    )
    numbered = number_by_hash(copies, "_hash", [key], "_place", within=["epoch"])
    rows = F.col("group_rows")
    in_epoch = F.ceil(F.col("_place") / accumulation)
    per_epoch = F.ceil(rows / accumulation)
    done = F.least(in_epoch * accumulation, rows) / rows
    return (
        numbered.withColumn("step", (F.col("epoch") - 1) * per_epoch + in_epoch)
        .withColumn("epoch_fraction", F.col("epoch") - 1 + done)
        .drop("_hash", "_place", "group_rows")
    )


#: Larger than any shard, so that they share no factor with its number of rows.
_PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
MAX_SHARD_ROWS = 2_000_000_000


def _hash_number(*parts):
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def shard_feed(examples, shards, key="example_id", seed=C.SHUFFLE_SEED):
    """Add ``shard``, ``slot`` and ``shard_rows``: a feed to be written once.

    A hash of seed and key deals the rows to shards and gives each a slot in its shard,
    from 0. Every epoch then takes the slots in an order of its own, which is worked out
    and not sorted, see :func:`epoch_feed`. A shard has at most ``MAX_SHARD_ROWS`` rows.
    """
    named = F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))
    rows = examples.withColumn("_hash", F.md5(named)).withColumn(
        "shard", _hash_number(F.lit(seed), F.lit("shard"), F.col(key)) % shards
    )
    numbered = number_by_hash(rows, "_hash", [key], "slot", within=["shard"])
    few = F.col("group_rows") <= MAX_SHARD_ROWS
    rows = F.when(few, F.col("group_rows")).otherwise(F.raise_error(F.lit("use more shards")).cast("long"))
    numbered = numbered.withColumn("slot", F.col("slot").cast("long") - 1)
    return numbered.withColumn("shard_rows", rows).drop("_hash", "group_rows")


def epoch_feed(feed, epoch, seed=C.SHUFFLE_SEED, accumulation=C.GRADIENT_ACCUMULATION, done=None):
    """The rows of an epoch with their ``place`` in their shard, from 0, and ``step``.

    A narrow stage: the place is an affine permutation of the slots, drawn by seed, epoch
    and shard, so a feed that stopped goes on without ordering the epoch again. ``done``
    has ``(shard, position)``: how many rows of the epoch each shard has taken; they are
    left out. Shards it does not name have taken none.
    """
    drawn = _hash_number(F.lit(seed), F.lit(epoch), F.col("shard"))
    prime = F.get(F.array(*[F.lit(p) for p in _PRIMES]), (drawn % len(_PRIMES)).cast("int"))
    rows = F.col("shard_rows")
    place = (F.col("slot") * (prime % rows) + drawn) % rows
    taken = feed.withColumn("epoch", F.lit(epoch)).withColumn("place", place)
    taken = taken.withColumn("step", F.floor(F.col("place") / accumulation) + 1)
    if done is None:
        return taken
    position = done.select(F.col("shard").alias("_shard"), F.col("position").alias("_position"))
    taken = taken.join(position, F.col("shard") == F.col("_shard"), "left")
    return taken.where(F.col("place") >= F.coalesce("_position", F.lit(0))).drop("_shard", "_position")


def running_tokens(steps, run="run_id", step="step", tokens="tokens"):
    """Add ``num_tokens``: tokens seen by the run up to each step."""
    return running_sum(steps, tokens, step, "num_tokens", within=[run])


def linear_rate(step, max_steps, peak=C.LEARNING_RATE):
    """Learning rate that falls from ``peak`` in a straight line to zero."""
    return F.lit(peak) * (1 - (step - 1) / max_steps)
