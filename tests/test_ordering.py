import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import ordering, similarity, training

RANDOM = random.Random(7)
# One group holds most of the rows, one key is null, many values are equal.
ROWS = [
    (RANDOM.choice(["hot"] * 6 + ["a", "b", None]), n, RANDOM.randint(0, 5))
    for n in range(3000)
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "g string, n int, v int")


def numbered_by_hand(group):
    places = {}
    for name in {group(r) for r in ROWS}:
        members = sorted((r for r in ROWS if group(r) == name), key=lambda r: (-r[2], r[1]))
        places |= {r[1]: at for at, r in enumerate(members, 1)}
    return places


@pytest.mark.parametrize("within", [[], ["g"]])
def test_number_rows(rows, within):
    order = [F.desc("v"), F.asc("n")]
    found = ordering.number_rows(rows, order, "place", within).collect()
    expected = numbered_by_hand(lambda r: r[0] if within else None)
    assert {r["n"]: r["place"] for r in found} == expected


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("within", [[], ["g"]])
def test_number_by_hash(rows, within, digits):
    hashed = rows.withColumn("h", F.md5(F.col("v").cast("string")))
    found = ordering.number_by_hash(hashed, "h", ["n"], "place", within, digits)
    groups = collections.defaultdict(list)
    for g, n, v in ROWS:
        groups[g if within else None].append((hashlib.md5(str(v).encode()).hexdigest(), n))
    expected, sizes = {}, {}
    for members in groups.values():
        for at, (_, n) in enumerate(sorted(members), 1):
            expected[n], sizes[n] = at, len(members)
    out = found.collect()
    assert {r["n"]: r["place"] for r in out} == expected
    assert {r["n"]: r["group_rows"] for r in out} == sizes


@pytest.mark.parametrize("slice_size", [1, 100, 10_000])
def test_running_sum(rows, slice_size):
    found = ordering.running_sum(rows, "v", "n", "total", ["g"], slice_size)
    totals, expected = collections.Counter(), {}
    for g, n, v in ROWS:
        totals[g] += v
        expected[n] = totals[g]
    assert {r["n"]: r["total"] for r in found.collect()} == expected


def test_steps_of_nine_examples(spark):
    """Nine rows make steps of four, four and one, three epochs make nine steps."""
    rows = training.assign_steps(spark.range(9).withColumnRenamed("id", "example_id")).collect()
    sizes = collections.Counter(r["step"] for r in rows)
    assert [sizes[s] for s in range(1, 10)] == [4, 4, 1] * 3
    fractions = {r["step"]: r["epoch_fraction"] for r in rows}
    assert fractions[1] == pytest.approx(4 / 9) and fractions[9] == 3.0
    per_epoch = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["step"]):
        per_epoch[r["epoch"]].append(r["example_id"])
    assert all(sorted(ids) == list(range(9)) for ids in per_epoch.values())
    assert per_epoch[1] != per_epoch[2]


def test_linear_rate(spark):
    steps = spark.range(1, 10).select(training.linear_rate(F.col("id"), F.lit(9)).alias("r"))
    rates = [r["r"] for r in steps.collect()]
    assert rates[0] == 2e-4
    assert rates[1] == pytest.approx(0.00017777777777777779)
    assert rates[3] == pytest.approx(0.00013333333333333334)


def test_rank_candidates(spark):
    pairs = spark.createDataFrame(
        [(1, 11, 0.2), (1, 12, 0.9), (1, 13, 0.2), (2, 11, -1.0)],
        "reference_id int, candidate_id int, similarity double",
    )
    found = {(r[0], r[1]): r["rank"] for r in similarity.rank_candidates(pairs).collect()}
    assert found == {(1, 12): 1, (1, 11): 2, (1, 13): 3, (2, 11): 1}


@pytest.mark.parametrize("rows", [1, 7, 500])
def test_a_sharded_feed_goes_on_where_it_stopped(spark, rows):
    feed = training.shard_feed(spark.range(rows).withColumnRenamed("id", "example_id"), 3).cache()
    orders = []
    for epoch in (1, 2):
        own = training.epoch_feed(feed, epoch).collect()
        shards = {}
        for r in own:
            shards.setdefault(r.shard, {})[r.place] = r.example_id
            assert r.step == r.place // 4 + 1
        assert all(sorted(s) == list(range(len(s))) for s in shards.values())
        assert sorted(r.example_id for r in own) == list(range(rows))
        orders.append(shards)
        done = spark.createDataFrame([(0, 2), (2, 1000)], "shard long, position long")
        left = training.epoch_feed(feed, epoch, done=done).collect()
        expected = {i for s, places in shards.items() for p, i in places.items() if p >= {0: 2, 2: 1000}.get(s, 0)}
        assert {r.example_id for r in left} == expected
    assert rows < 500 or orders[0] != orders[1]
