"""Helpers for native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it, also inside its own lambdas."""
    return F.transform(F.array(value), body)[0]


def upto(n: Column) -> Column:
    """The integers 0 to n - 1; none for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each place's combination of all values up to it (combine is associative), by doubling steps: n log n work,
    where appending one by one would copy the array n times."""

    def over(v: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda d: d < F.size(v))
        return F.aggregate(steps, v, lambda a, d: F.transform(a, lambda x, i: F.when(i >= d, combine(F.get(a, i - d), x)).otherwise(x)))

    return let(values, over)
