"""Vector column functions over arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def is_usable(a: Column, dimensions: int) -> Column:
    """The right length, and every entry finite."""
    finite = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(a) == dimensions) & finite, F.lit(False))


def to_text(a: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))


def from_text(text: Column) -> Column:
    return F.from_json(text, "array<float>")
