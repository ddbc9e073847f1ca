"""Connected components by alternating large and small stars, in DataFrame joins."""

from pyspark.sql import functions as F

from gradeloom.sources.staging import stage


def _smallest_beside(arcs):
    return arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges):
    """Every larger neighbour of a node is tied to the smallest one."""
    arcs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = arcs.join(_smallest_beside(arcs), "u").where("v > u and v != m")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges):
    """Every smaller neighbour of a node, and the node, is tied to the smallest one."""
    arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = _smallest_beside(arcs)
    tied = arcs.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(smallest.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _fingerprint(edges):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges):
    """``(node, component)`` of every node with an edge; the smallest node names it.

    ``edges`` has two columns; its rows may repeat, point either way or to themselves.
    Null ends are left out. A round is two joins on the edges left, of which there are
    no more than before, and there are about as many rounds as the logarithm of the
    longest path. Each round is written to the shared folder.
    """
    u, v = edges.columns
    edges = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u != v")
    edges = stage(edges.distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select("v", "v")).distinct()
