"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row.

    A chain of ``withColumn`` would do the same, but a later filter on the result is
    pushed down through such a chain with every intermediate column copied into each
    place it is used, which grows without bound. One expression is copied once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
