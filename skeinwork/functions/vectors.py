"""Vector functions over array columns; sums are in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero, null or holds a null, or where the lengths differ."""
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), norm(a) * norm(b)))


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Shares of exp(logit / temperature), shifted by the largest for safety."""
    scaled = F.transform(logits, lambda x: x.cast("double") / temperature)
    top = F.array_max(scaled)
    powers = F.transform(scaled, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return F.transform(powers, lambda x: x / total)
