"""Per-series least squares with prediction intervals, fully distributed.

Every series is reduced to its regression moments by one grouped aggregate
(``regr_*`` are algebraic, so partial aggregation applies), and the horizon is
generated with ``explode(sequence(1, h))`` on the fitted rows. Nothing about a
series is ever collected into one task beyond its five moments.
"""
from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import safe_div
from ..session import ensure_checkpoint_dir


def z_value(level: float) -> float:
    """Two-sided normal quantile for a central ``level`` interval (0.90 → 1.6449)."""
    return NormalDist().inv_cdf(0.5 + level / 2.0)


def fit_lines(df: DataFrame, keys: list[str], x: str, y: str, min_points: int = 3) -> DataFrame:
    """keys…, n, slope, intercept, sxx, syy, sxy, xbar, last_x (series with < ``min_points`` dropped)."""
    return (df.groupBy(*keys).agg(
                F.regr_count(F.col(y), F.col(x)).alias("n"),
                F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
                F.regr_syy(F.col(y), F.col(x)).alias("syy"),
                F.regr_sxy(F.col(y), F.col(x)).alias("sxy"),
                F.regr_avgx(F.col(y), F.col(x)).alias("xbar"),
                F.max(F.col(x)).alias("last_x"))
            .filter(F.col("n") >= min_points))


def forecast_grouped(df: DataFrame, keys: list[str], x: str, y: str, horizon: int,
                     level: float = 0.90, min_points: int = 3, method: str = "linear",
                     period: int | None = None) -> DataFrame:
    """OLS forecast ``horizon`` steps past each series' last x, with a ``level`` interval.

    Output: keys…, step, x_future, forecast, lower, upper, n.
    Interval: ŷ ± z·s·sqrt(1 + 1/n + (x−x̄)²/Sxx), s² = (Syy − Sxy²/Sxx)/(n−2).
    ``method="seasonal"`` adds an additive seasonal index: the mean residual of
    the series' points in the same phase ``x mod period`` (12 for months, 7
    for days), joined to the horizon rows on (keys, phase).
    A series whose x never changes has no line: its forecast and interval are NULL.
    """
    if method == "seasonal":
        return _seasonal(df, keys, x, y, horizon, level, min_points, period or 12)
    if method != "linear":
        raise ValueError(f"unknown method {method!r}")
    z = z_value(level)
    fit = fit_lines(df, keys, x, y, min_points)
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    xf = (F.col("last_x") + F.col("step")).cast("double")
    sse = F.col("syy") - safe_div(F.col("sxy") * F.col("sxy"), "sxx")
    sse = F.when(sse < 0, F.lit(0.0)).otherwise(sse)
    s = F.sqrt(safe_div(sse, F.col("n") - F.lit(2)))
    half = F.lit(z) * s * F.sqrt(F.lit(1.0) + F.lit(1.0) / F.col("n")
                                 + safe_div((xf - F.col("xbar")) * (xf - F.col("xbar")), "sxx"))
    yhat = F.col("intercept") + F.col("slope") * xf
    return steps.select(*keys, "step", (F.col("last_x") + F.col("step")).alias("x_future"),
                        yhat.alias("forecast"), (yhat - half).alias("lower"), (yhat + half).alias("upper"),
                        F.col("n"))



def _seasonal(df: DataFrame, keys: list[str], x: str, y: str, horizon: int, level: float,
              min_points: int, period: int) -> DataFrame:
    # the series feeds the fit, the residuals and the index: checkpoint it once (series-grain rows)
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(*keys, x, y).checkpoint(eager=True)
    lin = forecast_grouped(df, keys, x, y, horizon, level, min_points)
    fit = fit_lines(df, keys, x, y, min_points).select(*keys, "slope", "intercept")
    if keys:
        with_fit = df.join(fit, keys)   # both sides on the series grain
    else:   # one series: its fit is a pair of scalars
        with_fit = df.select("*", fit.select("slope").scalar().alias("slope"),
                             fit.select("intercept").scalar().alias("intercept"))
    resid = with_fit.select(
        *keys, (F.col(x) % period).alias("phase"),
        (F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x).cast("double"))).alias("r"))
    index = resid.groupBy(*keys, "phase").agg(F.avg("r").alias("season"))
    out = lin.withColumn("phase", F.col("x_future") % period).join(index, [*keys, "phase"], "left")
    s = F.coalesce(F.col("season"), F.lit(0.0))
    return out.select(*keys, "step", "x_future", (F.col("forecast") + s).alias("forecast"),
                      (F.col("lower") + s).alias("lower"), (F.col("upper") + s).alias("upper"), "n")
