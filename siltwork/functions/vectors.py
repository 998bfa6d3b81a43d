"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products; the longer vector is cut to the shorter."""
    d = lambda x: x.cast("array<double>")
    n = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(F.slice(d(a), 1, n), F.slice(d(b), 1, n), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a.cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if either vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
