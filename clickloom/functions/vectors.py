"""Dense-vector expressions over ARRAY<DOUBLE>."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def parse_vector(text: Column) -> Column:
    """JSON array text to ARRAY<DOUBLE>; its length is data, not schema."""
    return F.from_json(text, "array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """``a`` over its norm; the inner lambda variable keeps the norm from being
    computed again for every element."""
    return F.get(
        F.transform(
            F.array(l2_norm(a)),
            lambda n: F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(x)),
        ),
        F.lit(0),
    )


def blend(a: Column, b: Column, weight: float) -> Column:
    """``weight * a + (1 - weight) * b``, element by element."""
    return F.zip_with(a, b, lambda x, y: x * F.lit(weight) + y * F.lit(1.0 - weight))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def sigmoid(x: Column) -> Column:
    """Logistic function of a logit clipped to [-10, 10]."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(x, -10.0, 10.0)))


def log_loss(p: Column) -> Column:
    """Loss of a positive sample: ``-ln(max(p, 1e-10))``."""
    return -F.ln(F.greatest(p, F.lit(1e-10)))


def softmax(score: Column, temperature: float, *partition: str) -> Column:
    """Softmax of ``score / temperature`` in each partition, shifted by its maximum."""
    w = Window.partitionBy(*partition)
    scaled = score / F.lit(temperature)
    weight = F.exp(scaled - F.max(scaled).over(w))
    return weight / F.sum(weight).over(w)


def position_weights(k: int, favour: str = "oldest") -> list[float]:
    """``1/(i+1)`` normalised to sum 1.

    Slot 0 is the oldest click and gets the largest weight; ``favour="recent"``
    reverses the order.
    """
    raw = [1.0 / (i + 1) for i in range(k)]
    total = sum(raw)
    weights = [x / total for x in raw]
    return weights if favour == "oldest" else weights[::-1]


def seeded_vector(key: Column, dim: int, seed: int, scale: float) -> Column:
    """Normal vector that depends only on ``key`` and ``seed``.

    Box-Muller over hashed uniforms: a row gets the same start values whatever
    other rows exist and in whatever order they are read.
    """

    def uniform(index: Column, salt: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, index, F.lit(seed), F.lit(salt)), 11)
        return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))

    return F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.lit(scale)
        * F.sqrt(F.lit(-2.0) * F.ln(uniform(i, 1)))
        * F.cos(F.lit(6.283185307179586) * uniform(i, 2)),
    )
