"""Approximate distinct counts as stored, mergeable sketches.

A sketch (HyperLogLog, Spark's own functions) has a fixed size whatever it
counts; sketches of parts can be kept in a table and merged later, so that the
distinct count of a year comes from twelve stored rows and not from its orders.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Registers are 2**LG_K; a sketch takes at most about as many bytes.
LG_K = 12


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Stated bound of the relative error: ``deviations`` standard errors of 1.04 / sqrt(registers)."""
    return deviations * 1.04 / math.sqrt(2 ** lg_k)


def sketch(c: str | Column, lg_k: int = LG_K) -> Column:
    """Aggregate: the sketch of the distinct values of ``c`` (NULLs are not counted)."""
    return F.hll_sketch_agg(c, lg_k)


def merged(c: str | Column) -> Column:
    """Aggregate: the sketch of the union of the sketches in ``c``."""
    return F.hll_union_agg(c)


def estimate(c: str | Column) -> Column:
    """The distinct count that a sketch stands for."""
    return F.coalesce(F.hll_sketch_estimate(c), F.lit(0))


def within_error(est: Column, exact: Column, lg_k: int = LG_K) -> Column:
    """Whether an estimate keeps the stated bound (to one whole value)."""
    return F.abs(est - exact) <= F.greatest(exact * F.lit(relative_error(lg_k)), F.lit(1.0))
