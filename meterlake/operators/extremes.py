"""Seasonal extreme deviates: days that stand out from their weekday's median, found by repeated removal."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: makes the median absolute deviation of normal values estimate their standard deviation
NORMAL_MAD = 1.4826


def seasonal_extremes(df: DataFrame, keys: list[str], day: str, value: str, deviates: float = 3.5, max_share: float = 0.1,
                      min_points: int = 14) -> DataFrame:
    """``keys, day, value, expected, deviate`` of the extreme days of every series.

    Each value is taken less its series' median of that weekday. Of what is left, the value farthest from the
    median is removed while it is more than ``deviates`` standard deviations away, estimated as 1.4826 times the median
    absolute deviation of the values not yet removed; both are computed anew after each removal, so two extremes
    cannot hide each other, nor a large one a smaller. At most ``max_share`` of a series is removed (a series that
    deviates more often has no rule to deviate from). ``expected`` is the weekday's median plus the median of what
    stayed, ``deviate`` the distance from it in those deviations.

    One group per series and weekday, then one per series, has as many values as the calendar has days; the
    removal, which depends on its own last step, runs on arrays in ``applyInArrow``. Null values are left out, and series
    with fewer than ``min_points`` values or without spread have no extremes. ``keys`` are not null.
    """
    given = df.filter(F.col(day).isNotNull() & F.col(value).isNotNull()).select(*keys, F.col(day).alias("_d"), F.col(value).cast("double").alias("_y"))
    usual = given.groupBy(*keys, F.dayofweek("_d").alias("_w")).agg(F.median("_y").alias("_usual"))
    rest = given.withColumn("_w", F.dayofweek("_d")).join(usual, [*keys, "_w"]).drop("_w")
    types, normal = dict(df.dtypes), NORMAL_MAD
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"_d {types[day]}", "_y double", "expected double", "deviate double"])

    def find(table):
        # self-contained, so that workers need no module of this package
        import numpy as np
        import pyarrow as pa

        y, season = (table.column(c).to_numpy() for c in ("_y", "_usual"))
        left = y - season
        days = np.argsort(table.column("_d").to_numpy(), kind="stable")
        order = days[np.argsort(left[days], kind="stable")]   # ties by day
        r = left[order]

        def middle(x):
            half = (len(x) - 1) // 2, len(x) // 2
            x = np.partition(x, half)
            return (x[half[0]] + x[half[1]]) / 2.0

        low, high, centre, spread = 0, len(r), middle(r), 0.0
        for k in range(int(len(r) * max_share) + 1):
            centre = middle(r[low:high])
            spread = normal * middle(np.abs(r[low:high] - centre))
            above, below = r[high - 1] - centre, centre - r[low]
            if k == int(len(r) * max_share) or spread <= 0 or max(above, below) <= deviates * spread:
                break
            if below > above:
                low += 1
            else:
                high -= 1
        gone = np.concatenate((order[:low], order[high:])) if len(r) >= min_points else order[:0]
        expected = season[gone] + centre
        out = table.take(pa.array(gone))
        columns = {c: out.column(c) for c in (*keys, "_d", "_y")}
        with np.errstate(divide="ignore", invalid="ignore"):
            return pa.table({**columns, "expected": pa.array(expected), "deviate": pa.array((y[gone] - expected) / spread)})

    found = rest.groupBy(*keys).applyInArrow(find, schema)
    return found.withColumnsRenamed({"_d": day, "_y": value})
