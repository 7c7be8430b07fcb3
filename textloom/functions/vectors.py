"""Vector expressions on arrays of numbers, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import Name, col


def dot(a: Name, b: Name) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Name) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Name) -> Column:
    """Length 1; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(col(a), lambda x: x.cast("double") / n)).otherwise(F.transform(col(a), lambda x: x.cast("double")))


def cosine(a: Name, b: Name) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def mean_of(column: str, size: int) -> Column:
    """Aggregate: the element-wise mean of vectors of one size."""
    return F.array(*[F.avg(F.col(column)[i].cast("double")) for i in range(size)])
