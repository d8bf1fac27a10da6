"""Consumption prediction (P1–P4)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import rnd, safe_div
from ..operators import grains
from ..rules import RULES, Rules


def p1_next_day(df: DataFrame, history_days: int = 30) -> DataFrame:
    """Per-meter linear trend of daily kWh over the last ``history_days`` (+1) days → next day.

    The day index counts back from the meter's last day (a line's prediction
    does not depend on where its x begins); ``d >= last_day - 30`` keeps up to
    31 days, as in the reference. One day of history → NULL.
    """
    d = grains.daily(df)
    last = F.max("d").over(Window.partitionBy("meter_id"))
    win = d.select("meter_id", "d", "kwh", last.alias("last_day"), F.datediff("d", last).alias("day_idx"))
    fit = (win.filter(F.col("d") >= F.date_add("last_day", -history_days))
              .groupBy("meter_id")
              .agg(F.regr_slope("kwh", "day_idx").alias("slope"),
                   F.regr_intercept("kwh", "day_idx").alias("intercept"),
                   F.max("day_idx").alias("last_idx"), F.max("last_day").alias("last_day"),
                   F.avg("kwh").alias("avg_kwh")))
    return (fit.select("meter_id", "last_day", rnd("avg_kwh", 3).alias("avg_daily_kwh_30d"),
                       rnd(F.col("intercept") + F.col("slope") * (F.col("last_idx") + 1), 3)
                       .alias("predicted_next_day_kwh"),
                       rnd("slope", 4).alias("trend_kwh_per_day"))
            .orderBy(F.col("predicted_next_day_kwh").desc_nulls_last(), "meter_id"))


def p2_next_month(df: DataFrame, min_months: int = 3, drop_partial: bool = False,
                  rules: Rules = RULES, min_coverage: float = 0.5) -> DataFrame:
    """Per-meter linear trend over monthly totals (≥ ``min_months``) → next month, floored at 0.

    ``drop_partial=True`` ignores a meter's last month when it has readings on
    fewer than ``min_coverage`` of its calendar days (a file that ends mid-month).
    """
    aggs = [F.sum("energy_kwh").alias("kwh")]
    if drop_partial:
        aggs.append(F.count_distinct(grains.day_of(df)).alias("_days"))
    m = (df.groupBy("meter_id", "year", "month").agg(*aggs)
           .withColumn("m_idx", F.col("year") * 12 + F.col("month")))
    if drop_partial:
        dim = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
        m = m.withColumn("_last", F.max("m_idx").over(Window.partitionBy("meter_id")))
        partial = (F.col("m_idx") == F.col("_last")) & (F.col("_days") < dim * min_coverage)
        m = m.filter(~partial)
    fit = (m.groupBy("meter_id")
            .agg(F.regr_slope("kwh", "m_idx").alias("slope"), F.regr_intercept("kwh", "m_idx").alias("intercept"),
                 F.max("m_idx").alias("last_m"), F.count(F.lit(1)).alias("months_observed"))
            .filter(F.col("months_observed") >= min_months))
    nxt = F.col("last_m") + 1
    return (fit.select("meter_id", "months_observed",
                       F.expr("(last_m + 1 - 1) div 12").cast("int").alias("pred_year"),
                       ((nxt - 1) % 12 + 1).cast("int").alias("pred_month"),
                       rnd(F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * nxt), 2).alias("predicted_kwh"),
                       rnd("slope", 2).alias("monthly_trend_kwh"))
            .orderBy(F.col("predicted_kwh").desc_nulls_last(), "meter_id"))


def p3_load_profile(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Typical hour per meter: mean interval kWh × readings per hour."""
    return (df.groupBy("meter_id", "hour")
            .agg(rnd(F.avg("energy_kwh") * F.lit(float(rules.readings_per_hour)), 4).alias("avg_hourly_kwh"))
            .orderBy("meter_id", "hour"))


def p4_seasonal_index(df: DataFrame, per_year: bool = False) -> DataFrame:
    """Month-of-year kWh per meter and its ratio to the mean month.

    Default sums every year of a month and divides by its distinct meters (as
    the reference). ``per_year=True`` first computes kWh per meter for each
    (year, month), then averages over years. The empty window runs on ≤ 12 rows.
    """
    if per_year:
        ym = (df.groupBy("year", "month")
                .agg((F.sum("energy_kwh") / F.count_distinct("meter_id")).alias("_k")))
        monthly = ym.groupBy("month").agg(F.avg("_k").alias("kwh_per_meter"))
    else:
        monthly = df.groupBy("month").agg((F.sum("energy_kwh") / F.count_distinct("meter_id")).alias("kwh_per_meter"))
    mean = F.avg("kwh_per_meter").over(Window.partitionBy())
    return (monthly.select("month", rnd("kwh_per_meter", 2).alias("kwh_per_meter"),
                           rnd(safe_div("kwh_per_meter", mean), 3).alias("seasonal_index"))
            .orderBy("month"))
