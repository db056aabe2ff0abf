"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is all zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - cosine(a, b)


def squared_euclidean(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def is_zero(a: Column) -> Column:
    return ~F.exists(a, lambda x: x != 0)


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def relu(a: Column) -> Column:
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def softmax(a: Column) -> Column:
    """Shares by exponential, shifted by the largest entry so that large scores do not overflow."""

    def shares(e: Column) -> Column:
        return let(total(e), lambda t: F.transform(e, lambda x: x / t))

    return let(F.array_max(a), lambda top: let(F.transform(a, lambda x: F.exp(x - top)), shares))


def affinity(cos: Column, sigma: float = 0.5) -> Column:
    """Gaussian similarity of a cosine value."""
    gap = 1.0 - cos
    return F.exp(-(gap * gap) / (2.0 * sigma * sigma))


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounded value with negative zero folded into zero."""
    return F.round(value, digits) + F.lit(0.0)
