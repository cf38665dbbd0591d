"""Expressions over array columns: histograms, dense vectors and sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def dot(a: Column | str, b: Column | str, size: int) -> Column:
    """Inner product of two arrays of fixed ``size``; null if either is shorter.

    Written out term by term, so it compiles into the stage instead of running an
    interpreted lambda per element.
    """
    left, right = as_col(a), as_col(b)
    terms = [F.get(left, F.lit(i)) * F.get(right, F.lit(i)) for i in range(size)]
    return reduce(lambda x, y: x + y, terms)


def l2_norm(a: Column | str, size: int) -> Column:
    return F.sqrt(dot(a, a, size))


def cosine(a: Column, b: Column, norm_a: Column, norm_b: Column, size: int) -> Column:
    """Cosine from precomputed norms; 0 for (near-)zero vectors or missing arrays."""
    product = norm_a * norm_b
    return F.coalesce(F.when(product > F.lit(1e-9), dot(a, b, size) / product), F.lit(0.0))


def shared_count(a: Column, b: Column) -> Column:
    """Size of the set intersection, 0 when either side is null."""
    return F.coalesce(F.size(F.array_intersect(a, b)), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Set Jaccard similarity, 0 when both sides are empty or either is null."""
    union = F.size(F.array_union(a, b))
    both = a.isNotNull() & b.isNotNull() & (union > 0)
    return F.when(both, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))
