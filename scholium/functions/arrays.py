"""Functions on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_union(*arrays: Column) -> Column:
    """All elements once, in the order they are first met."""
    return F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]))


def sorted_unique(a: Column) -> Column:
    return F.array_sort(F.array_distinct(a))


def same_set(a: Column, b: Column) -> Column:
    """Whether two arrays have the same elements; null is the empty array."""
    none = F.array().cast("array<string>")
    return sorted_unique(F.coalesce(a, none)) == sorted_unique(F.coalesce(b, none))


def has(a: Column, predicate) -> Column:
    return F.coalesce(F.exists(a, predicate), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of numbers; null if either has length 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def flat_texts(c: Column, depth: int = 1) -> Column:
    """All values of an array of arrays (`depth` levels of them) as text in order, without nulls of any level."""
    for _ in range(depth):
        c = F.flatten(F.filter(c, lambda x: x.isNotNull()))
    return F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: x.cast("string"))
