import pytest
from pyspark.sql import functions as F, types as T

from gradeloom.catalog import model_queries
from gradeloom.operators import answers
from gradeloom.plans import judged


def counting(folder, fail_on=None):
    """A model that writes down every text it is asked."""

    def factory():
        import os
        import uuid

        def answer(texts, max_new_tokens):
            for text in texts:
                if fail_on is not None and text.endswith(fail_on):
                    raise RuntimeError("the run ends here")
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as seen:
                    seen.write(text)
            return [f"{text}!"[:max_new_tokens] for text in texts]

        return answer

    return factory


def asked(folder):
    return sorted(p.read_text() for p in folder.iterdir())


def prompts(spark, n=60):
    # A third of the rows share a prompt, one has none.
    rows = [(i, "shared" if i % 3 == 0 else f"p{i}") for i in range(n)] + [(n, None)]
    return spark.createDataFrame(rows, "n int, prompt string").repartition(5)


def test_a_second_run_asks_only_what_is_missing(spark, tmp_path):
    first, second, store = tmp_path / "a", tmp_path / "b", str(tmp_path / "store")
    first.mkdir(), second.mkdir()
    df = prompts(spark)
    with pytest.raises(Exception, match="the run ends here"):
        answers.generate_stored(df, "prompt", counting(str(first), "p31"), "m", store, parts=8)
    done = answers.read_answers(spark, store, T.StringType()).count()
    assert 0 < done < 41
    rows = answers.generate_stored(df, "prompt", counting(str(second)), "m", store, parts=8).collect()
    assert {r.n: r.response for r in rows} == {r.n: r.prompt and r.prompt + "!" for r in df.collect()}
    distinct = {r.prompt for r in df.collect() if r.prompt}
    assert len(asked(second)) == len(set(asked(second))) == len(distinct) - done
    # Nothing is left to ask; another model asks everything, in other parts as well.
    answers.generate_stored(df, "prompt", counting(str(second)), "m", store, parts=3).collect()
    assert len(asked(second)) == len(distinct) - done
    answers.generate_stored(df, "prompt", counting(str(second)), "other", store).collect()
    assert len(asked(second)) == 2 * len(distinct) - done


def test_stored_vectors(spark, tmp_path):
    df = prompts(spark, 7)
    store = str(tmp_path / "store")
    factory = lambda: lambda texts: [[float(len(t))] for t in texts]
    rows = answers.embed_stored(df, "prompt", factory, "length", store, parts=2).collect()
    assert {r.n: r.embedding for r in rows} == {r.n: r.prompt and [float(len(r.prompt))] for r in df.collect()}
    none = answers.embed_stored(df.limit(0), "prompt", factory, "length", store, parts=2)
    assert none.collect() == []


def test_stored_evaluation_is_the_same(spark, tmp_path):
    cases = model_queries.fixture(spark, "/root/testdata/sf0.001", "eval_cases").limit(20)
    models = {"base": model_queries.rule_model(), "tuned": model_queries.rule_model(["DATA_ERROR", "AUTH_ERROR"])}
    judge = model_queries.rule_judge()
    plain = judged.judged_evaluation(cases, models, judge)
    names = sorted(set(plain.columns) - {"judge_result"})
    plain = sorted(map(str, plain.select(*names).collect()))
    for _ in range(2):
        kept = judged.judged_evaluation(cases, models, judge, str(tmp_path / "store")).select(*names)
        assert sorted(map(str, kept.collect())) == plain
