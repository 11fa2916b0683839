"""Aggregates that answer NULL, not an error, on constant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present; NULL when either is constant there."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))
