"""Dense-vector expressions over ``array<double>`` columns (JVM-side higher-order functions)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.common import col, let

# Largest constant (cluster statistics, centroids) embedded into a plan, in numbers.
MAX_CONST_VALUES = 4_000_000


def as_double(v) -> Column:
    return col(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v) -> Column:
    """Unit length; a zero vector stays zero."""
    v = as_double(v)
    return let(norm(v), lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def scale(v, s) -> Column:
    return F.transform(col(v), lambda x: x * s)


def sq_dist(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


def cosine(a, b, eps: float = 1e-10) -> Column:
    """a.b / (|a| |b| + eps)."""
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))


def vsum(v) -> Column:
    return F.aggregate(col(v), F.lit(0.0), lambda acc, x: acc + x)


def to_json_text(v) -> Column:
    return F.to_json(col(v))


def from_json_text(c) -> Column:
    return F.from_json(col(c), "array<double>")


def const(value, ddl: str) -> Column:
    """A constant of type ``ddl`` from Python data, folded into one literal by Catalyst.

    Used for model parameters (centroids, per-cluster sums) whose size is checked first.
    """
    n = _count_numbers(value)
    if n > MAX_CONST_VALUES:
        raise ValueError(f"constant of {n} numbers exceeds the bound of {MAX_CONST_VALUES}; "
                         "reduce the number of clusters or the vector dimension")
    return F.from_json(F.lit(json.dumps(value)), ddl)


def _count_numbers(x) -> int:
    if isinstance(x, dict):
        return sum(_count_numbers(v) for v in x.values())
    if isinstance(x, (list, tuple)):
        return sum(_count_numbers(v) for v in x)
    return 1
