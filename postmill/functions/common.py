"""Small helpers shared by the column-expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Inside higher-order-function lambdas an outer expression is re-evaluated on every
    call; binding it through a one-element ``transform`` evaluates it exactly once.
    """
    return F.transform(F.array(value), body).getItem(0)


def empty_array(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")
