import math

import numpy as np

from gradeloom.llm import collision_projections as cp


def brute(rows, threshold=0.95):
    """(id: (links, component)) and the set of links, of distinct ids."""
    good = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    ids = sorted(good)
    links, label = set(), {i: i for i, _ in rows}
    for a, x in enumerate(ids):
        for y in ids[a + 1 :]:
            u, v = good[x], good[y]
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                links.add((x, y))
    changed = True
    while changed:
        changed = False
        for x, y in links:
            m = min(label[x], label[y])
            changed |= label[x] != m or label[y] != m
            label[x] = label[y] = m
    n = dict.fromkeys(label, 0)
    for x, y in links:
        n[x], n[y] = n[x] + 1, n[y] + 1
    return {i: (n[i], label[i]) for i in label}


def run(spark, rows, settings=cp.Settings()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {r.vec_id: (r.n_links, r.component_id) for r in cp.linked_vectors(df, settings).collect()}


def vectors(n, groups, spread, seed=3):
    rng = np.random.default_rng(seed)
    heads = rng.standard_normal((groups, 32))
    return [(i, (heads[i % groups] + spread * rng.standard_normal(32)).tolist()) for i in range(n)]


def test_groups(spark):
    rows = vectors(300, 100, 0.02)
    assert run(spark, rows) == brute(rows)


def test_crowded_windows_are_cut(spark):
    rows = vectors(150, 3, 0.02)
    assert run(spark, rows, cp.Settings(block=10)) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    settings = cp.Settings()
    plan = cp.plan_for(50_000, settings)
    found, pairs = 0, 400
    for _ in range(pairs):
        x, y = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        y = 0.95 * x + math.sqrt(1 - 0.95**2) * y
        drawn = rng.standard_normal((64, plan.tables, plan.planes + 1))
        a, b = (np.einsum("d,dtp->tp", v, drawn) for v in (x, y))
        hit = ((a[:, 1:] > 0) == (b[:, 1:] > 0)).all(1) & (abs(a[:, 0] - b[:, 0]) <= settings.half_window)
        found += hit.sum() >= settings.collisions
    assert found / pairs >= 0.95


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one), (2, one), (3, [2.0, 4.0, 6.0]), (4, None), (5, [0.0] * 3), (6, [float("nan"), 1.0, 1.0])]
    rows += [(7, [None, 1.0, 1.0]), (8, []), (9, [1.0, 2.0]), (10, [1e300, 2e300, 3e300]), (11, [float("inf")] * 3)]
    got = run(spark, rows)
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 10: (3, 1)} | {i: (0, i) for i in (4, 5, 6, 7, 8, 9, 11)}
    df = spark.createDataFrame(rows + [(1, one), (None, one)], "vec_id long, embedding array<double>")
    again = cp.linked_vectors(df.selectExpr("*", "1 as id", "2 as n_links")).collect()
    assert len(again) == len(rows) + 2
    assert [(r.n_links, r.component_id, r.kept) for r in again if r.vec_id is None] == [(0, None, True)]
    assert {r.n_links for r in again if r.vec_id == 1} == {3}
    assert cp.linked_vectors(df.limit(0)).collect() == []


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected = brute(rows)
    got = {r.vec_id: r.n_links for r in cp.op8_collision_projections(spark, sf).collect()}
    total = sum(n for n, _ in expected.values())
    assert all(got[i] <= n for i, (n, _) in expected.items())
    assert sum(got.values()) >= 0.98 * total
