"""Insight queries (A1–A6) and the outage-spell extension of A3."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, Window, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd, safe_div
from ..operators import grains
from ..operators.anomaly import anomaly_series
from ..operators.spells import outage_spells as _spells
from ..rules import RULES, Rules
from ..session import shared_dir
from .common import top_k

#: accuracy of the bracket around an exact quantile (the reciprocal of its rank error)
BRACKET = 10_000


def a1_anomaly_days(df: DataFrame, window: int = 30, sigmas: float = 3.0, n: int | None = 200,
                    min_history: int = 2, calendar: bool = False) -> DataFrame:
    """Meter-days deviating more than ``sigmas`` σ from the meter's previous ``window`` days: rows, or with
    ``calendar=True`` calendar days."""
    return anomaly_series(grains.daily(df), ["meter_id"], "d", "kwh", window, sigmas, min_history, n, calendar=calendar)


def a2_theft_indicator(df: DataFrame, min_prev_kwh: float = 5.0, drop_ratio: float = 0.4,
                       min_town_ratio: float = 0.9) -> DataFrame:
    """Meter-months whose kWh fell below ``drop_ratio`` × previous month while the town held up.

    The town trend is an aggregate over (town, year, month): a two-letter town
    prefix times calendar months. It is joined without a hint; Spark broadcasts
    it by its measured size, or splits a skewed town in the shuffle join.
    The meter-month series with its lag feeds both the trend and the join, so
    it is written once (Parquet, meters × months rows) instead of being
    computed from the readings twice.
    """
    monthly = (df.groupBy("meter_id", R.town().alias("town"), "year", "month")
                 .agg(F.sum("energy_kwh").alias("kwh")))
    w = Window.partitionBy("meter_id").orderBy("year", "month")
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "meter-months")
    monthly.withColumn("prev_kwh", F.lag("kwh").over(w)).write.parquet(path)
    with_lag = spark.read.parquet(path)
    town = (with_lag.groupBy("town", "year", "month")
                    .agg(safe_div(F.sum("kwh"), F.sum("prev_kwh")).alias("town_ratio")))
    j = with_lag.join(town, ["town", "year", "month"])
    flagged = j.filter((F.col("prev_kwh") > min_prev_kwh) & (F.col("kwh") < F.lit(drop_ratio) * F.col("prev_kwh"))
                       & (F.col("town_ratio") > min_town_ratio))
    return (flagged.select("meter_id", "year", "month", rnd("prev_kwh", 1).alias("prev_month_kwh"),
                           rnd("kwh", 1).alias("this_month_kwh"),
                           rnd(F.lit(100.0) * (safe_div(F.col("kwh"), F.col("prev_kwh")) - F.lit(1.0)), 1)
                           .alias("meter_change_pct"),
                           rnd(F.lit(100.0) * (F.col("town_ratio") - F.lit(1.0)), 1).alias("town_change_pct"))
            .orderBy(F.col("meter_change_pct").asc_nulls_last(), "meter_id", "year", "month"))


def a3_outage_hours(df: DataFrame, rules: Rules = RULES, min_readings: int = 10, n: int | None = 100) -> DataFrame:
    """Meter-days with at least ``min_readings`` zero-voltage readings (10 ≈ 30 min)."""
    days = (df.filter(F.col("avg_voltage") == 0)
              .groupBy("meter_id", R.reading_date().alias("d"))
              .agg(F.count(F.lit(1)).alias("outage_intervals"))
              .filter(F.col("outage_intervals") >= min_readings)
              .withColumn("est_outage_hours",
                          rnd(F.col("outage_intervals") * F.lit(float(rules.interval_minutes)) / F.lit(60.0), 2)))
    return top_k(days, n, F.col("est_outage_hours").desc(), F.col("meter_id"), F.col("d"))


def outage_spells(df: DataFrame, rules: Rules = RULES, min_readings: int = 1) -> DataFrame:
    """Consecutive zero-voltage runs per meter (what A3's comment calls spells)."""
    return _spells(df, rules, min_readings).orderBy("meter_id", "spell_start")


def a4_segments(df: DataFrame, rules: Rules = RULES, high_kwh: float = 8.0, medium_kwh: float = 3.0,
                evening_hours: tuple[int, int] = (18, 23), evening_ratio: float = 1.3,
                erratic_cv: float = 2.0) -> DataFrame:
    """Usage level (HIGH / MEDIUM / LOW) and pattern (EVENING_PEAKER / ERRATIC / FLAT) per meter."""
    e = F.col("energy_kwh")
    lo, hi = evening_hours
    pm = df.groupBy("meter_id").agg(
        (F.avg(e) * F.lit(float(rules.readings_per_day))).alias("avg_daily_kwh"),
        safe_div(F.stddev_samp(e), F.avg(e)).alias("variability"),
        safe_div(F.avg(F.when(F.col("hour").between(lo, hi), e)), F.avg(e)).alias("evening_ratio"))
    d = F.col("avg_daily_kwh")
    return (pm.select("meter_id", rnd(d, 2).alias("avg_daily_kwh"),
                      F.when(d >= high_kwh, "HIGH").when(d >= medium_kwh, "MEDIUM").otherwise("LOW")
                      .alias("usage_segment"),
                      F.when(F.col("evening_ratio") > evening_ratio, "EVENING_PEAKER")
                       .when(F.col("variability") > erratic_cv, "ERRATIC").otherwise("FLAT").alias("pattern_segment"))
            .orderBy(F.col("avg_daily_kwh").desc(), "meter_id"))


def a5_voltage_quality(df: DataFrame, statutory=(216.2, 253.0), contract=(220.0, 240.0)) -> DataFrame:
    """Per town: share of powered readings inside the statutory and the contract voltage band."""
    v = F.col("avg_voltage")
    t = (df.filter(v > 0).groupBy(R.town().alias("town"))
           .agg(F.count(F.lit(1)).alias("readings"),
                F.count_if(v.between(*statutory)).alias("_s"), F.count_if(v.between(*contract)).alias("_c")))
    return t.select("town", "readings",
                    rnd(F.lit(100.0) * F.col("_s") / F.col("readings"), 2).alias("pct_within_is12360"),
                    rnd(F.lit(100.0) * F.col("_c") / F.col("readings"), 2).alias("pct_within_220_240")).orderBy("town")


def _peak_threshold(fleet: DataFrame, bracket: tuple | None, n: int, quantile: float) -> F.Column:
    """The exact discrete quantile of ``fleet_kw_units`` as a scalar subquery: the values inside ``bracket`` (which holds it)
    are ranked, after the number of those below it."""
    if bracket is None:
        return F.lit(None).cast("bigint")
    low, high = bracket
    units = F.col("fleet_kw_units")
    below = fleet.agg(F.count_if(units < low)).scalar()
    inside = fleet.filter(units.between(low, high)).groupBy("fleet_kw_units").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("fleet_kw_units").rowsBetween(Window.unboundedPreceding, 0))
    rank = max(1, math.ceil(quantile * n))
    return (inside.withColumn("_upto", upto).filter(F.col("_upto") + below >= rank)
            .agg(F.min("fleet_kw_units")).scalar())


def a6_peak_contributors(df: DataFrame, quantile: float = 0.99, n: int | None = 20,
                         exact: bool = True, accuracy: int = 1_000_000, rules: Rules = RULES) -> DataFrame:
    """Meters behind the fleet's top-(1−quantile) demand intervals.

    Fleet demand is an exact integer sum of the 4-decimal ``power_kw`` (10^-4
    kW units), so the threshold comparison cannot lose a row to float-sum order.
    The fleet series (one row per timestamp) is written to the shared
    checkpoint folder because it feeds the threshold, the peak set and the
    peak total: computed once, and it survives the loss of an executor. The
    pass that writes it also brackets the quantile: ``percentile_approx`` keeps
    its rank error below ``1 / BRACKET``, so the approximate quantiles that far and
    as far again to either side have the exact one between them. The exact discrete quantile is then
    selected inside the bracket, a few ten-thousandths of the timestamps, within the final
    query; ``exact=False`` takes ``percentile_approx`` itself.
    The peak set is joined on its month and time, so months without a peak are
    pruned from a partitioned scan; Spark broadcasts it by its measured size.
    """
    units = 10.0 ** rules.power_decimals
    spark, seen = df.sparkSession, Observation("fleet")
    path = shared_dir(spark, "fleet-demand")
    probs = [max(quantile - 2 / BRACKET, 0.0), min(quantile + 2 / BRACKET, 1.0)] if exact else [quantile]
    series = grains.fleet_interval(df, rules.power_decimals).select("reading_ts", "fleet_kw_units")
    (series.observe(seen, F.count(F.lit(1)).alias("n"),
                    F.percentile_approx("fleet_kw_units", probs, BRACKET if exact else accuracy).alias("q"))
     .write.parquet(path))
    fleet = spark.read.schema(series.schema).parquet(path)
    q = seen.get["q"]
    threshold = (_peak_threshold(fleet, tuple(q) if q else None, seen.get["n"], quantile) if exact
                 else F.lit(q[0] if q else None).cast("bigint"))
    peaks = fleet.filter(F.col("fleet_kw_units") >= threshold).select(
        F.year("reading_ts").alias("year"), F.month("reading_ts").alias("month"), "reading_ts", "fleet_kw_units")
    total = peaks.agg(F.sum("fleet_kw_units")).scalar()
    rows = df.select("meter_id", "year", "month", "reading_ts", grains.scaled_units("power_kw", rules.power_decimals).alias("_pw"))
    hit = rows.join(peaks.drop("fleet_kw_units"), ["year", "month", "reading_ts"], "left_semi")
    per_meter = hit.groupBy("meter_id").agg(F.count(F.lit(1)).alias("peak_intervals"), F.sum("_pw").alias("_pw"))
    out = per_meter.select(
        "meter_id", "peak_intervals",
        rnd(F.col("_pw").cast("double") / F.lit(units) / F.col("peak_intervals"), 3).alias("avg_kw_during_peaks"),
        rnd(safe_div(F.col("_pw").cast("double"), total.cast("double")) * F.lit(100.0), 2).alias("pct_of_peak_load"))
    return top_k(out, n, F.col("pct_of_peak_load").desc_nulls_last(), F.col("meter_id"))
