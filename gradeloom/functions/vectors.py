"""Vector expressions over ``array<float|double>`` columns, one row at a time."""

from pyspark.sql import functions as F

MIN_NORM = 1e-12


def let(value, body):
    """``body(value)`` with the value worked out once, not once per element."""
    return F.transform(F.array(value), body)[0]


def _total(array):
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def _dot(left, right):
    return _total(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    )


def _norm(vector):
    return F.greatest(F.sqrt(_dot(vector, vector)), F.lit(MIN_NORM))


def cosine(left, right):
    """Cosine of the angle; 0 when either vector is all zeros."""
    return _dot(left, right) / (_norm(left) * _norm(right))


def softmax(logits):
    """Probabilities of a logit array, shifted by the largest logit."""
    return let(
        F.array_max(logits).cast("double"),
        lambda top: let(
            F.transform(logits, lambda x: F.exp(x.cast("double") - top)),
            lambda weights: let(
                _total(weights),
                lambda total: F.transform(weights, lambda weight: weight / total),
            ),
        ),
    )
