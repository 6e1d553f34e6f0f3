"""Vector arithmetic on array columns, evaluated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def l2_normalize(a: Column) -> Column:
    """Each value over the norm plus epsilon: a zero vector stays zero."""
    # the length is that of the only element of an array, so it isn't summed again for each value
    return F.flatten(F.transform(F.array(norm(a) + EPSILON), lambda n: F.transform(a, lambda x: x / n)))


def cosine(a: Column, b: Column) -> Column:
    return dot(l2_normalize(a), l2_normalize(b))


def search_cosine(row: Column, query: Column) -> Column:
    """The text search's form of the cosine: epsilon on the query's norm and on the product of norms."""
    return dot(row, query) / (norm(row) * (norm(query) + EPSILON) + EPSILON)


def usable(a: Column, dim: int) -> Column:
    sound = F.forall(a, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(a) == dim) & sound & F.exists(a, lambda x: x != 0), F.lit(False))
