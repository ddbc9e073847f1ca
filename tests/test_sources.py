import json

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import quality, runlog
from gradeloom.sources import readers, staging, writers
from gradeloom.streaming import responses as stream

OUTPUT = {"category": "A", "root_cause": "b", "recommendation": "c"}


def test_array_with_a_bad_element(spark, tmp_path):
    rows = [
        {"example_id": 0, "instruction": "i", "input": "x", "output": OUTPUT},
        {"example_id": 1, "instruction": "i", "input": "x", "output": "text"},
        {"example_id": 2, "instruction": "i", "output": {"category": "A"}},
        {"example_id": 3, "instruction": "i", "input": "x", "output": '{"category": "A"}'},
    ]
    (tmp_path / "rows.json").write_text(json.dumps(rows, indent=2))
    df = readers.read_examples(spark, str(tmp_path / "rows.json"), multi_line=True)
    found = {r["example_id"]: r for r in df.select("example_id", "input", "output").collect()}
    assert found[0]["output"].asDict() == OUTPUT
    assert found[1]["output"] is None and found[1]["input"] == "x"
    assert found[2]["input"] is None and found[2]["output"]["category"] == "A"
    errors = {r[0]: r[1] for r in quality.validate_examples(df).collect()}
    assert errors == {0: [], 1: ["output has to be an object"], 2: ["missing fields: input"],
                      3: ["output has to be an object"]}


def test_eval_cases_and_run_log(spark, tmp_path):
    case = {"case_id": 1, "input": "é", "expected_category": "A",
            "expected_root_cause": "b", "expected_recommendation": "c"}
    (tmp_path / "cases.json").write_text(json.dumps([case]), encoding="utf-8")
    assert readers.read_eval_cases(spark, str(tmp_path / "cases.json"), True).first().asDict() == case
    log = {"run_id": 1, "max_steps": 9, "epoch": 3.0, "best_metric": None,
           "log_history": [{"step": 1, "loss": 2.5, "epoch": 0.5}, {"step": 3, "eval_loss": 2.0}]}
    (tmp_path / "log.json").write_text(json.dumps(log, indent=1))
    row = readers.read_run_log(spark, str(tmp_path / "log.json"), True).first()
    assert row["source_file"].endswith("log.json") and row["max_steps"] == 9
    assert [e["loss"] for e in row["log_history"]] == [2.5, None]


def test_files_without_ids(spark, tmp_path):
    rows = [{"instruction": f"i{n}", "input": "x", "output": OUTPUT} for n in range(3)]
    (tmp_path / "rows.json").write_text(json.dumps(rows, indent=2))
    df = readers.read_examples(spark, str(tmp_path / "rows.json"), multi_line=True)
    assert {r.example_id: r.instruction for r in df.collect()} == {0: "i0", 1: "i1", 2: "i2"}
    cases = [{"input": f"c{n}", "expected_category": "A"} for n in range(2)]
    (tmp_path / "cases.json").write_text(json.dumps(cases))
    found = readers.read_eval_cases(spark, str(tmp_path / "cases.json"), True).collect()
    assert {r.case_id: r.input for r in found} == {0: "c0", 1: "c1"}
    (tmp_path / "lines.json").write_text(json.dumps(cases[0]))
    with pytest.raises(Exception, match="a line has no case_id"):
        readers.read_eval_cases(spark, str(tmp_path / "lines.json")).collect()


def test_run_logs_without_ids_stay_apart(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for name in "ab":
        history = [{"step": s, "epoch": float(s), "eval_loss": 1.0} for s in range(1, 5)]
        (logs / f"{name}.json").write_text(json.dumps({"epoch": 4.0, "log_history": history}))
    entries = runlog.flatten_run_log(readers.read_run_log(spark, str(logs), True))
    assert entries.select("run_id", "source_file").distinct().count() == 2
    kept = runlog.retain_checkpoints(entries.select("run_id", "step"))
    assert sorted(r.step for r in kept.collect()) == [3, 3, 4, 4]
    assert runlog.epoch_summary(entries).count() == 8


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_write_splits(spark, tmp_path, file_format):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 20, "validation").otherwise("train"))
    path = str(tmp_path / file_format)
    writers.write_splits(df, path, file_format)
    back = spark.read.format(file_format).load(path)
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {
        "validation": 20, "train": 80}


def test_staged_tables_keep_rows_and_schema(spark):
    df = spark.range(5).select("id", F.array("id").alias("a"))
    staged = staging.stage(df, "test")
    assert sorted(staged.collect()) == sorted(df.collect())
    assert staged.inputFiles()[0].find(staging.staging_dir(spark).split(":")[-1]) >= 0


def test_staging_folder(spark, monkeypatch):
    """The session's folder comes first; only a local session may do without."""
    named = spark.conf.get(staging.CHECKPOINT_SETTING, None)
    if named:
        assert staging.staging_dir(spark) == named.rstrip("/")
    monkeypatch.setattr(staging, "CHECKPOINT_SETTING", "spark.gradeloom.unset")
    own = staging.staging_dir(spark)
    assert own == staging.staging_dir(spark) != named

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.gradeloom.unset"):
        staging.staging_dir(Cluster)


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    answer = "DATA_ERROR\nRoot cause: " + "a" * 20 + "\nRecommended action: " + "b" * 20
    rows = [{"response_id": 1, "case_id": 1, "model": "m", "response": answer},
            {"response_id": 2, "case_id": 2, "model": "m", "response": "nothing"}]
    (source / "1.json").write_text("\n".join(map(json.dumps, rows)))
    for run in range(3):  # each run takes what is new, and nothing twice
        if run:
            row = {"response_id": run * 10, "case_id": 1, "model": "m", "response": answer}
            (source / f"{run}0.json").write_text(json.dumps(row))
        query = stream.write_analyses(
            stream.read_responses(spark, str(source)), str(tmp_path / "out"), str(tmp_path / "progress")
        )
        assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    found = {r["response_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found[1]["is_valid"] and found[1]["category"] == "DATA_ERROR"
    assert not found[2]["is_valid"] and found[2]["category"] is None
