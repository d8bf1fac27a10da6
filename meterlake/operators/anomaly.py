"""Rolling z-score anomalies over (keyed) daily series."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import rnd, safe_div
from .grains import day_number


def rolling_scores(series: DataFrame, keys: list[str], order: str, value: str,
                   window: int = 30, min_history: int = 2, calendar: bool = False) -> DataFrame:
    """Adds mu, sigma (sample) and history (rows) over the ``window`` preceding rows, or with ``calendar=True`` (and
    a date as ``order``) over the rows of the ``window`` calendar days before.

    The window is partitioned by the series keys and runs on a series grain
    (one row per key and day), never on raw readings. ``keys=[]`` is a single
    fleet series (one row per day: small by construction).
    """
    by = Window.partitionBy(*keys) if keys else Window.partitionBy()
    if calendar:
        w = by.orderBy(day_number(order)).rangeBetween(-window, -1)
    else:
        w = by.orderBy(order).rowsBetween(-window, -1)
    scored = series.select("*", F.avg(value).over(w).alias("mu"), F.stddev_samp(value).over(w).alias("sigma"),
                           F.count(F.col(value)).over(w).alias("history"))
    return scored.filter(F.col("history") >= min_history)


def anomaly_series(series: DataFrame, keys: list[str], order: str, value: str, window: int = 30,
                   sigmas: float = 3.0, min_history: int = 2, n: int | None = 200,
                   value_decimals: int = 3, noise: float = 1e-9, calendar: bool = False) -> DataFrame:
    """Points farther than ``sigmas`` sample deviations from their trailing mean.

    A deviation of less than ``noise`` of the mean is the rounding error of
    sums in double, not a spread: such a series has no anomalies.
    Output: keys…, order, value, rolling_mean_30d, z_score, anomaly_type
    (SPIKE above the mean, COLLAPSE below), strongest first, top ``n``.
    """
    s = rolling_scores(series, keys, order, value, window, min_history, calendar)
    dev = F.col(value) - F.col("mu")
    spread = F.col("sigma") > F.lit(noise) * F.greatest(F.abs(F.col("mu")), F.abs(F.col(value)))
    flagged = s.filter(spread & (F.abs(dev) > F.lit(sigmas) * F.col("sigma")))
    z = safe_div(dev, F.col("sigma"))
    out = flagged.select(
        *keys, order, rnd(value, value_decimals).alias(value), rnd("mu", value_decimals).alias("rolling_mean_30d"),
        rnd(z, 2).alias("z_score"),
        F.when(F.col(value) > F.col("mu"), "SPIKE").otherwise("COLLAPSE").alias("anomaly_type"),
        rnd(F.abs(z), 6).alias("_strength"))
    out = out.orderBy(F.col("_strength").desc(), *keys, order)
    if n:
        out = out.limit(n)
    return out.drop("_strength")
