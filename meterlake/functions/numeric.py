"""Numeric helpers with engine-independent results."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, n: int) -> Column:
    """Round half-up to ``n`` decimals through DECIMAL(38,12).

    Going through a fixed-scale decimal drops float noise below 1e-12 first, so
    a value that is a tie in decimal (1.005) rounds the same way whatever the
    order of the float operations that produced it. Result is DOUBLE.
    """
    return F.round(_c(c).cast("decimal(38,12)"), n).cast("double")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (SQL ``x / NULLIF(y, 0)``)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def pct(part, whole) -> Column:
    """100.0 * part / whole in double, NULL for a zero whole."""
    return safe_div(F.lit(100.0) * _c(part), whole)
