"""Array and numeric Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fit_length(a: Column | str, n: int, pad) -> Column:
    """Pad ``a`` on the right with ``pad`` up to ``n`` elements, or cut it to
    its first ``n`` elements. A NULL array is treated as empty."""
    if n < 0:
        raise ValueError("n must be >= 0")
    arr = F.coalesce(_c(a), F.array_repeat(F.lit(pad), 0))
    return F.slice(F.concat(arr, F.array_repeat(F.lit(pad), n)), 1, n)


def argmax(z: Column | str) -> Column:
    """0-based index of the largest element; the first one on ties; NaN is
    larger than any number (so a NaN wins), as NumPy's argmax."""
    z = _c(z)
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def multiply(a: Column | str, b: Column | str) -> Column:
    """Elementwise product of two arrays of the same length."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def _logsumexp(z: Column) -> Column:
    m = F.array_max(z)
    return m + F.log(F.aggregate(z, F.lit(0.0).cast("double"),
                                 lambda acc, x: acc + F.exp(x - m)))


def log_softmax(z: Column | str) -> Column:
    z = _c(z)
    lse = _logsumexp(z)
    return F.transform(z, lambda x: x - lse)


def softmax(z: Column | str) -> Column:
    z = _c(z)
    lse = _logsumexp(z)
    return F.transform(z, lambda x: F.exp(x - lse))


def cross_entropy(z: Column | str, y: Column | str) -> Column:
    """Per-row cross entropy ``logsumexp(z) - z[y]`` for logits ``z`` and a
    0-based class ``y`` (NULL when ``y`` is outside ``z``). Averaging it
    over rows gives the usual mean cross-entropy loss."""
    z = _c(z)
    return _logsumexp(z) - F.get(z, _c(y))
