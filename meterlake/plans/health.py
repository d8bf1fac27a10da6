"""Meter-health queries (Q08, Q09, Q13, Q18, Q19, Q24, Q25)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd
from .common import latest_period, top_k


def q08_health_summary(df: DataFrame, period: str = "year", approx_meters: bool = False,
                       at: tuple[int, int] | None = None) -> DataFrame:
    """Readings, meters and mean score per status in the latest ``period`` (year | month | all).

    ``approx_meters=True`` counts meters with ``approx_count_distinct`` (HyperLogLog++, ~1 % error):
    one pass with a fixed-size sketch per group instead of an exact distinct aggregation.
    """
    meters = F.approx_count_distinct("meter_id") if approx_meters else F.count_distinct("meter_id")
    return (latest_period(df, period, at).groupBy("health_status")
            .agg(F.count(F.lit(1)).alias("readings"), meters.alias("meters"),
                 rnd(F.avg("health_score"), 1).alias("avg_score"))
            .orderBy(F.col("readings").desc(), "health_status"))


def q09_health_trend(df: DataFrame) -> DataFrame:
    return (df.groupBy("year", "month").agg(rnd(F.avg("health_score"), 2).alias("avg_health_score"))
            .orderBy("year", "month"))


def q13_unhealthiest(df: DataFrame, n: int = 20) -> DataFrame:
    m = df.groupBy("meter_id").agg(rnd(F.avg("health_score"), 1).alias("avg_health_score"),
                                   F.count(F.lit(1)).alias("readings"))
    return top_k(m, n, F.col("avg_health_score").asc_nulls_last(), F.col("meter_id"))


def q18_overvoltage(df: DataFrame, n: int = 50) -> DataFrame:
    m = (df.filter(F.col("health_status") == "CRITICAL")
         .groupBy("meter_id", "year", "month").agg(F.count(F.lit(1)).alias("critical_readings")))
    return top_k(m, n, F.col("critical_readings").desc(), F.col("meter_id"), F.col("year"), F.col("month"))


def q19_dead_meters(df: DataFrame, min_readings: int = 400) -> DataFrame:
    """Meter-days with more than ``min_readings`` energised-but-idle readings (400 ≈ 20 h)."""
    return (df.filter(F.col("health_status") == "POSSIBLE_METER_ISSUE")
            .groupBy("meter_id", R.reading_date().alias("reading_date"))
            .agg(F.count(F.lit(1)).alias("zero_readings"))
            .filter(F.col("zero_readings") > min_readings)
            .orderBy(F.col("zero_readings").desc(), "meter_id", "reading_date"))


def q24_kpis(df: DataFrame) -> DataFrame:
    """One-row KPI snapshot.

    ``count(DISTINCT CASE …)`` four times would expand every reading four
    times; instead each meter is reduced to flags and sums first (partial
    aggregation keeps a hot meter local), then one tiny global aggregate.
    """
    s = F.col("health_status")
    per_meter = df.groupBy("meter_id").agg(
        F.max((s == "HEALTHY").cast("int")).alias("h"), F.max((s == "WARNING").cast("int")).alias("w"),
        F.max((s == "CRITICAL").cast("int")).alias("c"), F.count(F.lit(1)).alias("n"),
        F.sum("energy_kwh").alias("e"), F.sum("avg_voltage").alias("v"),
        F.sum("avg_current").alias("a"), F.sum("health_score").alias("sc"))
    n = F.sum("n")
    return per_meter.agg(
        F.count(F.lit(1)).alias("total_meters"),
        F.sum("h").cast("bigint").alias("meters_seen_healthy"),
        F.sum("w").cast("bigint").alias("meters_seen_warning"),
        F.sum("c").cast("bigint").alias("meters_seen_critical"),
        rnd(F.sum("e") / n, 5).alias("avg_interval_kwh"),
        rnd(F.sum("v") / n, 1).alias("avg_voltage"),
        rnd(F.sum("a") / n, 2).alias("avg_current"),
        rnd(F.sum("sc") / n, 1).alias("avg_health_score"))


def q25_dominant_status(df: DataFrame, period: str = "month", at: tuple[int, int] | None = None) -> DataFrame:
    """Meters by their most frequent status in the latest period (ties → alphabetically first status)."""
    counts = latest_period(df, period, at).groupBy("meter_id", "health_status").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("meter_id").orderBy(F.col("n").desc(), F.col("health_status"))
    top = counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return (top.groupBy("health_status").agg(F.count(F.lit(1)).alias("meters"))
            .orderBy(F.col("meters").desc(), "health_status"))
