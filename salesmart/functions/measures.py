"""Aggregate expressions shared by marts and reports.

Money is DECIMAL while aggregating (exact, order-independent sums) and
becomes DOUBLE only at the output. Ratios are decimal divisions rounded
half-up, which is what NUMERIC rounding does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column, scale: int = 2) -> Column:
    """ROUND(c, scale) as DOUBLE."""
    return F.round(c, scale).cast("double")


def total(col: str, scale: int = 2) -> Column:
    """ROUND(SUM(col), scale) as DOUBLE."""
    return money(F.sum(col), scale)


def ratio(num: Column, den: Column, scale: int) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) as DOUBLE (NULL when den is 0 or NULL)."""
    return F.round(F.try_divide(num, F.nullif(den, F.lit(0))), scale).cast("double")


def mean(col: str, scale: int) -> Column:
    """ROUND(AVG(col), scale) computed as an exact decimal SUM / COUNT."""
    return F.round(F.try_divide(F.sum(col), F.nullif(F.count(col), F.lit(0))), scale).cast("double")
