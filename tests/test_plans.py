"""What the plans of the queries must and must not contain."""

import re

import pytest

import __spark_entry__ as spark_entry

SF_DIR = "/root/testdata/sf0.001"
# The queries of the llm subpackage have tests of their own.
QUERIES = {
    name: build
    for name, build in spark_entry.queries().items()
    if not re.match(r"op\d+_|pipeline$", name)
}
USES_A_MODEL = {"predict", "judge", "embed", "judged_evaluation", "judged_comparison"}

PYTHON_NODES = re.compile("BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups")


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("simple")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(set(QUERIES) - USES_A_MODEL))
def test_plan(name, spark, capsys):
    plan = plan_of(QUERIES[name](spark, SF_DIR), capsys)
    assert not PYTHON_NODES.search(plan)
    assert "RoundRobinPartitioning" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_small_cases_are_broadcast_and_large_ones_shuffled(spark, capsys):
    query = QUERIES["category_accuracy"]
    assert "BroadcastHashJoin" in plan_of(query(spark, SF_DIR), capsys)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(query(spark, SF_DIR), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_scans_read_only_what_is_used(spark, capsys):
    plan = plan_of(QUERIES["split_by_hash"](spark, SF_DIR), capsys)
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_top_k_is_limited_before_the_shuffle(spark, capsys):
    plan = plan_of(QUERIES["retain_checkpoints"](spark, SF_DIR), capsys)
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ["field_similarity", "similarity_summary", "case_report"])
def test_generated_code_stays_small_enough_to_compile(name, spark):
    """Code that the JVM can't compile is interpreted, several times slower."""
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")  # such code is an error
    try:
        QUERIES[name](spark, SF_DIR).collect()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)
