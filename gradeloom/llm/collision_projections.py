"""Near-duplicate vectors by counting collisions on one-dimensional projections.

Each of many tables has a random line and a few random hyperplanes. Vectors on one side
of all the hyperplanes are sorted along the line, and each query collides with what
lies in a window centred on it. Pairs that collide in enough tables are verified by
their cosine in double precision. The number of hyperplanes grows with the logarithm
of the number of vectors, so that a cell holds about as many at every size; the number
of tables follows from the recall wanted for pairs right at the threshold.

Equal vectors are one from the start. Crowded windows are cut into blocks that meet
pairwise, so that a task never holds more than two blocks.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from gradeloom.llm.catalog import query
from gradeloom.llm.components import components
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage


WINDOW_ROWS = 10_000


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    half_window: float = 0.35
    collisions: int = 2
    recall: float = 0.98
    block: int = 2000
    seed: int = 7


@dataclass(frozen=True)
class Plan:
    planes: int
    tables: int


def collision_chance(planes, settings):
    """Chance that a pair right at the threshold collides in one table."""
    same_side = 1 - math.acos(settings.cosine) / math.pi
    distance = math.sqrt(2 - 2 * settings.cosine)
    return same_side**planes * math.erf(settings.half_window / distance / math.sqrt(2))


def plan_for(n, settings):
    """Hyperplanes and tables for ``n`` vectors."""
    planes = max(2, math.ceil(math.log2(max(n, 2))) - 4)
    p, tables = collision_chance(planes, settings), settings.collisions
    missed = lambda m: sum(
        math.comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(settings.collisions)
    )
    while missed(tables) > 1 - settings.recall:
        tables += 1
    return Plan(planes, tables)


def _unit(column):
    """Rows of an Arrow list column as unit vectors in double precision."""
    x = np.array(column.to_pylist(), np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(column):
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        F.col(column).isNotNull()
        & F.forall(column, finite)
        & F.exists(column, lambda x: x != 0)
    )


def _windows(vectors, plan, settings):
    """A row for each vector and table in its own window step and in the next one."""

    def place_batches(batches):
        drawn = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            for size in np.unique(lengths):
                if size not in drawn:
                    rng = np.random.default_rng([settings.seed, int(size)])
                    drawn[size] = rng.standard_normal((int(size), plan.tables, plan.planes + 1))
                rows = np.flatnonzero(lengths == size)
                unit = _unit(batch.column(1).take(pa.array(rows)))
                placed = np.einsum("nd,dtp->ntp", unit, drawn[size], optimize=True)
                sides = (placed[:, :, 1:] > 0) @ (1 << np.arange(plan.planes, dtype=np.int64))
                line = placed[:, :, 0]
                step = np.floor(line / settings.half_window).astype(np.int64)
                table = np.broadcast_to(np.arange(plan.tables, dtype=np.int64), line.shape)
                for own in (True, False):
                    columns = [
                        table.ravel() + (int(size) << 20), sides.ravel(), (step + (not own)).ravel(),
                        np.repeat(ids[rows], plan.tables), line.ravel(),
                    ]
                    flags = pa.array(np.full(line.size, own))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns] + [flags], ["t", "cell", "step", "id", "line", "own"]
                    )

    schema = "t long, cell long, step long, id long, line double, own boolean"
    return vectors.select("id", "vector").mapInArrow(place_batches, schema)


def _collisions(windows, groups, settings):
    """(x, y) for each table in which a pair collides.

    Steps are small, so many of them, and two blocks at most of a crowded one, are
    worked on together in each of ``groups`` groups.
    """
    key = ["t", "cell", "step"]
    sizes = stage(windows.groupBy(*key).agg(F.count("*").alias("rows"), F.max("own").alias("met")), "window-sizes")
    # Steps with a single vector, or with neighbours only, hold no pair of their own.
    sizes = sizes.where("rows > 1 and met").select(*key, F.ceil(F.col("rows") / settings.block).alias("blocks"))
    dealt = windows.join(sizes, key).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")))
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda j: F.struct(F.least("b", j).alias("i"), F.greatest("b", j).alias("j")),
    )
    dealt = dealt.withColumn("meet", F.explode(meets))

    def collide(frame):
        keys = [frame[c].to_numpy() for c in (*key, "i", "j")]
        line = frame["line"].to_numpy()
        order = np.lexsort([line, *keys[::-1]])
        keys, line = [k[order] for k in keys], line[order]
        ids, own, b = (frame[c].to_numpy()[order] for c in ("id", "own", "b"))
        new = np.concatenate([[False], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        window, alone = np.cumsum(new), keys[-2] == keys[-1]
        found, at, ahead = [np.zeros((0, 2), np.int64)], np.arange(len(line)), 1
        while len(at):
            at = at[at + ahead < len(line)]
            other = at + ahead
            near = (window[at] == window[other]) & (line[other] - line[at] <= settings.half_window)
            at, other = at[near], other[near]
            # Two neighbours meet in their own step; two of one block meet alone.
            met = (own[at] | own[other]) & (alone[at] | (b[at] != b[other]))
            pair = np.column_stack([ids[at[met]], ids[other[met]]])
            found.append(np.sort(pair, axis=1))
            ahead += 1
        pairs = np.concatenate(found)
        return pd.DataFrame({"x": pairs[:, 0], "y": pairs[:, 1]})

    blocks = dealt.where("meet.i != meet.j or blocks = 1 or b = meet.i")
    columns = [*key, F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "id", "line", "own", "b"]
    group = F.pmod(F.xxhash64(*key, "i", "j"), F.lit(groups)).alias("group")
    rows = blocks.select(*columns).select(group, "*")
    return rows.groupBy("group").applyInPandas(collide, "x long, y long")


def _verified(pairs, vectors, settings):
    left = vectors.select(F.col("id").alias("x"), F.col("vector").alias("vx"))
    right = vectors.select(F.col("id").alias("y"), F.col("vector").alias("vy"))
    joined = pairs.join(left, "x").join(right, "y").select("x", "y", "vx", "vy")

    def verify_batches(batches):
        for batch in batches:
            if batch.num_rows:
                cosine = (_unit(batch.column("vx")) * _unit(batch.column("vy"))).sum(1)
                batch = batch.filter(pa.array(cosine >= settings.cosine))
            yield batch.select(["x", "y"])

    return joined.mapInArrow(verify_batches, "x long, y long")


def linked_vectors(df, settings=Settings(), key="vec_id", vector="embedding"):
    """``key``, ``n_links``, ``component_id`` and ``kept`` of each row of ``df``.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    with a null key, are linked with nothing. Vectors of different lengths are never
    linked. Rows that repeat a key and a vector count as one vector and are repeated.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("valid", F.coalesce(_valid("vector") & F.col("id").isNotNull(), F.lit(False)))
    rows = stage(rows.withColumn("name", F.when(F.col("valid"), F.xxhash64("vector"))), "vectors")
    heads = (
        rows.where("valid")
        .select("id", "name", "vector")
        .distinct()
        .groupBy("name", "vector")
        .agg(F.min("id").alias("head"), F.count("*").alias("copies"))
    )
    heads = stage(heads, "heads")
    vectors = heads.select(F.col("head").alias("id"), "vector")
    size = vectors.count()
    plan = plan_for(size, settings)
    groups = 1 + size * plan.tables // WINDOW_ROWS
    windows = stage(_windows(vectors, plan, settings), "windows")
    counted = _collisions(windows, groups, settings).groupBy("x", "y").agg(F.count("*").alias("n"))
    candidates = counted.where(F.col("n") >= settings.collisions).select("x", "y")
    links = stage(_verified(candidates, vectors, settings), "links")
    both = links.union(links.select("y", "x")).toDF("head", "other")
    weights = heads.select(F.col("head").alias("other"), "copies")
    n_links = both.join(weights, "other").groupBy("head").agg(F.sum("copies").alias("links"))
    found = components(links).toDF("head", "component")
    named = (
        heads.join(n_links, "head", "left")
        .join(found, "head", "left")
        .select(
            F.col("name"),
            F.col("vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "head").alias("component_id"),
        )
    )
    joined = rows.join(named, ["name", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


@query("op8_collision_projections")
def op8_collision_projections(spark, sf_dir):
    return linked_vectors(read(spark, sf_dir, "embeddings"))
