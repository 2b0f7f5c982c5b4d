"""Vectors in a list column: which rows have one that can be calculated with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common_length(vectors: DataFrame, column: str) -> int:
    """The length that most vectors have, the longer one of two equally frequent; 0 without vectors."""
    sizes = vectors.filter(vectors[column].isNotNull()).groupBy(F.size(vectors[column]).alias("length")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("length")).first()
    return first["length"] if first else 0


def usable(vector: Column, length: int) -> Column:
    """Whether a vector has ``length`` entries, none of them NULL, NaN or infinite."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == length) & whole, F.lit(False))


def scaled_floor(vector: Column, factor: int) -> Column:
    """floor(factor * entry) of every entry, as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(factor))))
