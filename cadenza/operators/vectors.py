"""Vector helpers on plain ``array<double>`` columns (JVM higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(x: Column, c: Column) -> Column:
    """Sum of squared differences of two equal-length arrays, added in index order."""
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda acc, v: acc + v)


def nearest(x: Column, centres: list[list[float]]) -> tuple[Column, Column]:
    """Index (0-based, ties -> lowest) and squared distance of the nearest centre.

    ``centres`` is a model parameter (k short vectors), so it travels inside the
    plan as a literal; no join and no Python per row.
    """
    lit_centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    d = F.transform(lit_centres, lambda c: squared_distance(x, c))
    best = F.array_min(d)
    return (F.array_position(d, best) - 1).cast("int"), best
