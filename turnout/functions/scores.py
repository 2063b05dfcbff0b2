"""Column expressions over several predictions of one row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def mean_of(*columns: Column) -> Column:
    """Plain mean; NULL if one of the columns is NULL."""
    return reduce(add, columns) / F.lit(float(len(columns)))


def k_extreme_mean(columns: list[Column], k: int = 2, which: str = "smallest") -> Column:
    """Mean of the k smallest (or largest) values; NULL counts as absent.

    NULL if fewer than k values are present.
    """
    if which not in ("smallest", "largest"):
        raise ValueError("which must be 'smallest' or 'largest'")
    present = F.array_compact(F.array(*columns))
    ordered = F.sort_array(present, asc=which == "smallest")
    total = F.aggregate(F.slice(ordered, 1, k), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(present) >= k, total / F.lit(float(k)))


# longest product that is unrolled; one of 100 is more code than the JVM compiles, and four times slower than a fold
UNROLLED = 32


def dot(left: Column, right: Column, length: int) -> Column:
    """Dot product of two arrays of known length, unrolled so that it is compiled, or folded in the same order."""
    if length > UNROLLED:
        products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    return reduce(add, [left[i].cast("double") * right[i].cast("double") for i in range(length)])


def hybrid_label(participated: Column, prediction: Column) -> Column:
    return F.when(participated == 1, F.lit(1.0)).otherwise(prediction)
