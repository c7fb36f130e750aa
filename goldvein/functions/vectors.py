"""Dense-vector arithmetic on ``array<float|double>`` columns, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of element products. Vectors of unequal length raise an error
    (as a dimension mismatch does in SQL); a NULL vector gives NULL."""
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    total = F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(F.size(a) == F.size(b), total)
            .otherwise(F.raise_error(F.lit("vector dimensions differ")).cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """dot / (|a| |b|); NULL for a zero vector. Pass precomputed norms to
    compute them once per row rather than once per pair."""
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    return dot(a, b) / F.nullif(na * nb, F.lit(0.0))
