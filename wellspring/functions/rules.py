"""Rules as data, folded into single Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Searched CASE: the value of the first true condition, else ``default``."""
    expr = None
    for cond, value in cases:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def apply_updates(df: DataFrame, updates: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Apply ``UPDATE df SET column = value WHERE predicate`` statements in order.

    Each statement sees the rows as left by the previous one. The chain of
    projections collapses into one Project, so the whole batch of updates is
    a single narrow pass with no shuffle.
    """
    for column, value, predicate in updates:
        df = df.withColumn(column, F.when(predicate, value).otherwise(F.col(column)))
    return df
