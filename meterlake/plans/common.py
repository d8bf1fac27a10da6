"""Helpers shared by the query plans."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def top_k(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """``ORDER BY … LIMIT n`` (TakeOrderedAndProject: a per-task top-n, then a merge).

    Callers always end ``order`` with the group key so ties resolve the same
    way on every run.
    """
    out = df.orderBy(*order)
    return out.limit(n) if n else out


def latest_period(df: DataFrame, period: str = "year", at: tuple[int, int] | None = None) -> DataFrame:
    """Rows of the latest year / month present (``period="all"``: every row).

    ``at`` names the latest year and month, as ``latest_partition`` reads them from the folder names of a partitioned
    table: months outside are pruned and no file is opened to find them. Without it
    the maximum is a scalar subquery (computed once, no join); on a
    partitioned Parquet scan a predicate on the partition columns against it
    prunes whole month folders.
    """
    if period not in ("all", "year", "month"):
        raise ValueError(f"unknown period {period!r}")
    if period == "all":
        return df
    ym = F.col("year") * 100 + F.col("month")
    if at is not None:
        latest = F.col("year") == at[0]
        return df.filter(latest if period == "year" else latest & (F.col("month") == at[1]))
    if period == "year":
        return df.filter(F.col("year") == df.agg(F.max("year")).scalar())
    return df.filter(ym == df.agg(F.max(ym)).scalar())
