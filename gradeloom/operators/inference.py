"""Models over table columns: the one place where rows go to Python.

A model is given as a factory, called once per worker process and operator call;
what it returns takes a list of texts and gives back a list of the same length.
"""

import uuid

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gradeloom import constants as C

#: The model loaded last in this worker process, under the call it belongs to.
_LOADED = {}


def _loaded(call, factory):
    if call not in _LOADED:
        _LOADED.clear()
        _LOADED[call] = factory()
    return _LOADED[call]


def apply_model(df, column, factory, name, result_type, batch_size=256):
    """Add what a model makes of each text in ``column``, as ``result_type``.

    A null text gives null and does not reach the model.
    """
    call = uuid.uuid4().hex
    schema = T.StructType(df.schema.fields + [T.StructField(name, result_type)])
    arrow_type = to_arrow_type(result_type)

    def run(batches):
        for batch in batches:
            values = batch.column(column).to_pylist()
            places = [i for i, value in enumerate(values) if value is not None]
            answers = [None] * len(values)
            for start in range(0, len(places), batch_size):
                chosen = places[start : start + batch_size]
                made = _loaded(call, factory)([values[i] for i in chosen])
                if len(made) != len(chosen):
                    raise ValueError(f"the model gave {len(made)} answers to {len(chosen)} texts")
                for i, answer in zip(chosen, made):
                    answers[i] = answer
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(answers, type=arrow_type)],
                names=batch.schema.names + [name],
            )

    return df.mapInArrow(run, schema)


def generate(
    df,
    prompt,
    factory,
    name="response",
    max_new_tokens=C.MAX_NEW_TOKENS["quality"],
    batch_size=32,
):
    """Add one generated text per prompt; the model also gets ``max_new_tokens``.

    Decoding is meant to be greedy, so that a task that runs again gives the same
    answers. Write the result out before several jobs read it (``stage``), or
    each of them generates anew; ``answers.generate_stored`` also goes on from a broken run.
    """
    return apply_model(df, prompt, limited(factory, max_new_tokens), name, T.StringType(), batch_size)


def limited(factory, max_new_tokens):
    def load():
        model = factory()
        return lambda texts: model(texts, max_new_tokens)

    return load


def embed(df, text, factory, name="embedding", batch_size=256):
    """Add one vector per text."""
    vector = T.ArrayType(T.FloatType())
    return apply_model(df, text, factory, name, vector, batch_size)


def embed_together(df, columns, factory, batch_size=256):
    """Add ``<column>_vector`` for several text columns.

    A text that a batch of rows holds more than once goes to the model once.
    """
    call = uuid.uuid4().hex
    vector = T.ArrayType(T.FloatType())
    schema = T.StructType(
        df.schema.fields + [T.StructField(f"{column}_vector", vector) for column in columns]
    )

    def run(batches):
        for batch in batches:
            texts = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
            distinct = [*dict.fromkeys(t for values in texts for t in values if t is not None)]
            known = {None: None}
            for start in range(0, len(distinct), batch_size):
                chosen = distinct[start : start + batch_size]
                made = _loaded(call, factory)(chosen)
                if len(made) != len(chosen):
                    raise ValueError(f"the model gave {len(made)} answers to {len(chosen)} texts")
                known.update(zip(chosen, made))
            added = [pa.array([known[t] for t in values], to_arrow_type(vector)) for values in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return df.mapInArrow(run, schema)


def tokenize_with(df, text, factory, name="ids", batch_size=256):
    """Add the ids that a tokenizer library gives each text."""
    ids = T.ArrayType(T.IntegerType())
    return apply_model(df, text, factory, name, ids, batch_size)
