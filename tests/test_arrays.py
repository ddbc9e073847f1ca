import json
import random

import pytest
from pyspark.sql import functions as F

from gradeloom.sources import arrays, readers


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "é", "日", "😀", "a", " ", "\n", '\\"']) for _ in range(rng.randrange(25)))


def values(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.randrange(8)
        if kind < 4:
            out.append({"id": i, odd_text(rng) or "k": odd_text(rng), "in": {"list": [odd_text(rng), {}, [1, [2]]]}})
        else:
            out.append([odd_text(rng), rng.random(), None, True, [[], odd_text(rng)], {"}": "]"}][kind - 4 : kind - 3][0])
    return out


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_elements_across_many_ranges(spark, tmp_path, small_ranges):
    files = {"a": values(1, 400), "b": values(2, 3), "empty": [], "flat": [*range(50)], "one": [{"x": "}" * 3000}]}
    for name, content in files.items():
        layout = {"indent": 2} if name == "a" else {"ensure_ascii": False}
        (tmp_path / f"{name}.json").write_text(" \n" + json.dumps(content, **layout) + "\n")
    rows = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert rows.select(F.spark_partition_id()).distinct().count() > 20
    found = {}
    for r in arrays.read_array_elements(spark, str(tmp_path)).collect():
        own = found.setdefault(r.file.rsplit("/", 1)[1][:-5], {})
        assert r.place not in own
        own[r.place] = json.loads(r.element)
    for name, content in files.items():
        assert found.get(name, {}) == dict(enumerate(content)), name


def test_a_large_array_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    cases = [
        {"input": f"failed {{ at [{i}", "expected_category": "X", "expected_root_cause": 'a "quoted" \\ cause', "expected_recommendation": "r"}
        for i in range(300)
    ]
    (tmp_path / "cases.json").write_text(json.dumps(cases, indent=1))
    rows = readers.read_eval_cases(spark, str(tmp_path / "cases.json"), multi_line=True)
    got = {r.case_id: (r.input, r.expected_root_cause) for r in rows.collect()}
    assert got == {i: (c["input"], c["expected_root_cause"]) for i, c in enumerate(cases)}


def test_a_file_that_is_no_array_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"input": "x"}, nonsense]')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_eval_cases(spark, str(tmp_path / "bad.json"), multi_line=True).collect()
