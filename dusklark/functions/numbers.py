"""Small numeric helpers that keep NULL, NaN and infinity apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The value, or NULL where it is NULL, NaN or infinite."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two sums, NULL where the denominator isn't positive."""
    return F.when(denominator > 0, numerator / denominator)


def holds(predicate: Column) -> Column:
    """A predicate in which an unknown comparison counts as false."""
    return F.coalesce(predicate, F.lit(False))
