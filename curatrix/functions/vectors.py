"""Vector functions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda x, y: x + y)


def doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - a.b / (|a| |b| + 1e-8)``."""
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(1e-8))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))
