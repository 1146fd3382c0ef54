"""Array-of-number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERY_NORM_FLOOR = 1e-9  # fixed value added to the norm of a query vector


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    norm = l2_norm(v)
    return F.transform(v, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)))


def normalize_query(v: Column) -> Column:
    """Query-side scaling, with a small floor on the norm."""
    norm = l2_norm(v) + F.lit(QUERY_NORM_FLOOR)
    return F.transform(v, lambda x: x.cast("double") / norm)
