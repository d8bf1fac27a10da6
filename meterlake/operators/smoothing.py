"""Exponential smoothing per series: Holt's level and trend, the parameters chosen inside one fold per series."""
from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.0, 0.1, 0.3)


def _fold(points: Column, alpha: Column, beta: Column) -> Column:
    """Level, trend and sum of squared one-step errors after all points (structs ``x, y`` in order of ``x``). The forecast
    for a point reaches over as many steps as ``x`` has moved, so missing steps are bridged by the trend."""
    first = points[0]
    start = F.struct(first["x"].alias("x"), first["y"].alias("level"), F.lit(0.0).alias("trend"), F.lit(0.0).alias("sse"))

    def step(at: Column, p: Column) -> Column:
        dx = (p["x"] - at["x"]).cast("double")
        ahead = at["level"] + at["trend"] * dx
        error = p["y"] - ahead
        return F.struct(p["x"].alias("x"), (ahead + alpha * error).alias("level"),
                        (at["trend"] + alpha * beta * error / dx).alias("trend"), (at["sse"] + error * error).alias("sse"))

    return F.aggregate(F.slice(points, F.lit(2), F.size(points)), start, step)


def smoothing_forecast(df: DataFrame, keys: list[str], x: str, y: str, horizon: int, confidence: float = 0.90,
                       alphas=ALPHAS, betas=BETAS, min_points: int = 3) -> DataFrame:
    """``keys, x_future, step, forecast, lower, upper, alpha, beta`` for ``horizon`` steps after each series' last point.

    One group per series gathers its points (whole ``x``, one ``y`` each, nulls left out), as many as the calendar has steps; a fold for each pair of
    parameters runs over the ordered array, and the pair with the least squared one-step error stays (ties: the first
    in the order of the grid). The interval takes the mean squared one-step error and its growth with the step,
    ``1 + sum over j below h of (alpha * (1 + beta * j))**2``. Series with fewer than ``min_points`` points have no forecast.
    """
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    grid = F.array(*(F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(i).alias("place"))
                     for i, (a, b) in enumerate((a, b) for a in alphas for b in betas)))
    given = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    series = (given.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(x).cast("bigint").alias("x"), F.col(y).cast("double").alias("y")))).alias("points"))
              .filter(F.size("points") >= min_points))

    def fitted(p: Column) -> Column:
        end = _fold(F.col("points"), p["alpha"], p["beta"])
        return F.struct(end["sse"].alias("sse"), p["place"].alias("place"), p["alpha"].alias("alpha"), p["beta"].alias("beta"),
                        end["level"].alias("level"), end["trend"].alias("trend"), end["x"].alias("x"))

    best = series.select(*keys, F.size("points").alias("n"), F.array_min(F.transform(grid, fitted)).alias("b"))
    steps = best.select(*keys, "n", "b.*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    h = F.col("step").cast("double")
    gained = F.aggregate(F.filter(F.sequence(F.lit(0), F.lit(horizon)), lambda j: (j >= 1) & (j < F.col("step"))), F.lit(1.0),
                         lambda acc, j: acc + (F.col("alpha") * (F.lit(1.0) + F.col("beta") * j)) * (F.col("alpha") * (F.lit(1.0) + F.col("beta") * j)))
    spread = F.lit(z) * F.sqrt(F.col("sse") / (F.col("n") - 1) * gained)
    forecast = F.col("level") + F.col("trend") * h
    return steps.select(*keys, (F.col("x") + F.col("step")).alias("x_future"), "step", forecast.alias("forecast"),
                        (forecast - spread).alias("lower"), (forecast + spread).alias("upper"), "alpha", "beta")
