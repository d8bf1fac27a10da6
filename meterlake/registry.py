"""Name → callable(spark, sf_dir) for every registered query.

Parameters that differ from the library defaults are listed here and in
FIXTURES.md F6 (the stand-in has about one reading per meter-day, so the
dense-data thresholds of Q19, A2 and A3 are lowered).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .functions import readings as RD
from .functions.numeric import rnd
from .operators import grains
from .operators.anomaly import anomaly_series
from .operators.regression import forecast_grouped
from .plans import consumption as C, dashboard as D, health as H, insights as A, power_quality as P, predict as PR
from .sources.curated import latest_partition
from .testdata import curated_path, curated_table, daily_table, rollup_table

Query = Callable[[SparkSession, str], DataFrame]


def _on_curated(fn, **params) -> Query:
    """Query over the curated Parquet table (written once per application from the stand-in)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(curated_table(spark, sf_dir), **params)
    run.__name__ = fn.__name__
    return run


def _of_latest(fn, **params) -> Query:
    """Query over the latest period of the curated table, which the names of its folders tell."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(curated_table(spark, sf_dir), at=latest_partition(spark, curated_path(spark, sf_dir)), **params)
    run.__name__ = fn.__name__
    return run


def _on_rollup(fn, **params) -> Query:
    """Dashboard feed over the hourly rollup Parquet table (written once per application)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(rollup_table(spark, sf_dir), **params)
    run.__name__ = fn.__name__
    return run


def _on_daily(fn, **params) -> Query:
    """Day- and month-grain query over the daily rollup (up to 480 times fewer rows than the readings)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(daily_table(spark, sf_dir), **params)
    run.__name__ = fn.__name__
    return run


def _hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup operator itself, computed from the curated table (not read back)."""
    return grains.hourly_rollup(curated_table(spark, sf_dir), laid_out=True)


def _worst_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grains.hourly_rollup(curated_table(spark, sf_dir), laid_out=True).select("meter_id", "hour_ts", "worst_health_status")


def _dashboard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    roll = rollup_table(spark, sf_dir)
    return D.dashboard_filter(roll, since="1996-01-01", until="1999-01-01", towns=["BR"],
                              statuses=["CRITICAL", "WARNING", "POSSIBLE_METER_ISSUE"])


def _town_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.town_view(curated_table(spark, sf_dir), ["MH"], "town_view_mh")


def _forecast_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-meter monthly kWh, three months ahead, 90 % interval."""
    m = grains.monthly(curated_table(spark, sf_dir)).withColumn("x", F.col("year") * 12 + F.col("month") - 1)
    fc = forecast_grouped(m, ["meter_id"], "x", "kwh", 3, 0.90)
    return fc.select("meter_id", D.month_from_index("x_future").alias("period"), "step",
                     rnd("forecast", 2).alias("forecast_kwh"), rnd("lower", 2).alias("lower_kwh"),
                     rnd("upper", 2).alias("upper_kwh"))


def _forecast_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-meter monthly kWh, three months ahead, linear trend plus month-of-year index."""
    m = grains.monthly(curated_table(spark, sf_dir)).withColumn("x", F.col("year") * 12 + F.col("month") - 1)
    fc = forecast_grouped(m, ["meter_id"], "x", "kwh", 3, 0.90, method="seasonal", period=12)
    return fc.select("meter_id", D.month_from_index("x_future").alias("period"), "step",
                     rnd("forecast", 2).alias("forecast_kwh"), rnd("lower", 2).alias("lower_kwh"),
                     rnd("upper", 2).alias("upper_kwh"))


def _anomaly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily kWh per town, 30-row rolling z-score, every anomaly (no top-k)."""
    c = curated_table(spark, sf_dir)
    series = c.groupBy(RD.town().alias("town"), RD.reading_date().alias("d")).agg(F.sum("energy_kwh").alias("kwh"))
    return anomaly_series(series, ["town"], "d", "kwh", n=None)


def registered_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for fn in (C.q01_daily_kwh, C.q02_fleet_daily_avg, C.q03_monthly_kwh, C.q16_trend_7d_ma, C.q23_mom_growth,
               PR.p1_next_day, PR.p2_next_month, A.a1_anomaly_days):
        q[fn.__name__] = _on_daily(fn)
    for fn in (C.q16_trend_7d_ma, C.q23_mom_growth, A.a1_anomaly_days):
        q[f"{fn.__name__}_calendar"] = _on_daily(fn, calendar=True)
    for fn in (C.q04_top_consumers,
               C.q05_peak_hours, P.q06_voltage_bands, P.q07_current_bands,
               H.q09_health_trend, C.q10_weekend_split, P.q11_hourly_power, P.q12_abnormal_voltage,
               H.q13_unhealthiest, P.q14_peak_load, P.q15_base_load,
               P.q17_voltage_trend, H.q18_overvoltage, P.q20_freq_stability, C.q21_heatmap,
               P.q22_high_load, H.q24_kpis,
               P.q26_load_factor, P.q27_sag_swell, C.q28_completeness):
        q[fn.__name__] = _on_curated(fn)
    for fn in (H.q08_health_summary, H.q25_dominant_status):
        q[fn.__name__] = _of_latest(fn)
    q["q19_dead_meters"] = _on_curated(H.q19_dead_meters, min_readings=0)
    for fn in (PR.p3_load_profile, PR.p4_seasonal_index, A.a4_segments, A.a5_voltage_quality, A.a6_peak_contributors,
               A.outage_spells):
        q[fn.__name__] = _on_curated(fn)
    q["a2_theft_indicator"] = _on_daily(A.a2_theft_indicator, min_prev_kwh=0.005)
    q["a3_outage_hours"] = _on_curated(A.a3_outage_hours, min_readings=2)
    q["hourly_rollup"] = _hourly_rollup
    q["worst_status"] = _worst_status
    for fn in (D.d01_kpi_tiles, D.d02_health_gauge, D.d03_health_pie, D.d04_monthly_line,
               D.d05_monthly_forecast, D.d06_status_bar, D.d07_daily_line, D.d08_daily_forecast,
               D.d09_daily_anomalies, D.d10_top_consumers, D.d11_heatmap, D.d12_weekend_trend,
               D.d13_power_combo, D.d14_forecast_narrative, D.d15_voltage_trend, D.d16_current_trend,
               D.d19_health_trend):
        q[fn.__name__] = _on_rollup(fn)
    for fn in (D.d17_voltage_band_bar, D.d18_unhealthy_table, D.d20_outage_by_meter):
        q[fn.__name__] = _on_curated(fn)
    q["dashboard_filter"] = _dashboard_filter
    q["town_view"] = _town_view
    q["forecast_grouped"] = _forecast_grouped
    q["forecast_seasonal"] = _forecast_seasonal
    q["daily_rollup"] = _on_curated(grains.daily_rollup, laid_out=True)
    q["q08_health_summary_month"] = _of_latest(H.q08_health_summary, period="month")
    q["p4_seasonal_index_per_year"] = _on_curated(PR.p4_seasonal_index, per_year=True)
    q["p2_next_month_drop_partial"] = _on_curated(PR.p2_next_month, drop_partial=True)
    q["a6_peak_contributors_approx"] = _on_curated(A.a6_peak_contributors, exact=False, accuracy=1_000_000)
    q["q21_heatmap_wide"] = _on_curated(C.q21_heatmap, wide=True)
    q["anomaly_series"] = _anomaly_series
    from .registry_curation import registered as curation_queries
    q.update(curation_queries())
    from .registry_streaming import registered as streaming_queries
    q.update(streaming_queries())
    from .registry_maintenance import registered as maintenance_queries
    q.update(maintenance_queries())
    return dict(sorted(q.items()))
