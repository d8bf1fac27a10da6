"""Power-quality queries (Q06, Q07, Q11, Q12, Q14, Q15, Q17, Q20, Q22, Q26, Q27)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd, safe_div
from ..rules import RULES, Rules
from .common import top_k


def q06_voltage_bands(df: DataFrame) -> DataFrame:
    """Readings per voltage band and share of all readings.

    The empty window runs on the aggregated frame (at most four rows).
    """
    counts = df.groupBy("voltage_band").agg(F.count(F.lit(1)).alias("readings"))
    total = F.sum("readings").over(Window.partitionBy())
    return (counts.select("voltage_band", "readings",
                          rnd(F.lit(100.0) * F.col("readings") / total, 2).alias("pct"))
            .orderBy(F.col("readings").desc(), "voltage_band"))


def q07_current_bands(df: DataFrame) -> DataFrame:
    return (df.groupBy("current_band")
            .agg(F.count(F.lit(1)).alias("readings"), rnd(F.avg("avg_current"), 2).alias("avg_amps"))
            .orderBy(F.col("readings").desc(), "current_band"))


def q11_hourly_power(df: DataFrame) -> DataFrame:
    return (df.groupBy("hour")
            .agg(rnd(F.avg("power_kw"), 3).alias("avg_power_kw"), rnd(F.max("power_kw"), 3).alias("max_power_kw"))
            .orderBy("hour"))


def q12_abnormal_voltage(df: DataFrame, rules: Rules = RULES, min_pct: float = 5.0) -> DataFrame:
    """Meters with more than ``min_pct`` % of readings outside the contract band."""
    lo, hi = rules.normal_voltage_min, rules.over_voltage
    m = df.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(~F.col("avg_voltage").between(lo, hi)).alias("abnormal"))
    share = F.lit(100.0) * F.col("abnormal") / F.col("total_readings")
    return (m.filter(share > min_pct)
            .select("meter_id", "total_readings", "abnormal", rnd(share, 2).alias("abnormal_pct"))
            .orderBy(F.col("abnormal_pct").desc(), "meter_id"))


def q14_peak_load(df: DataFrame, n: int = 50) -> DataFrame:
    daily = df.groupBy("meter_id", R.reading_date().alias("reading_date")).agg(
        rnd(F.max("power_kw"), 3).alias("peak_kw"))
    return top_k(daily, n, F.col("peak_kw").desc_nulls_last(), F.col("meter_id"), F.col("reading_date"))


def q15_base_load(df: DataFrame, n: int = 50) -> DataFrame:
    daily = (df.filter(F.col("power_kw") > 0)
             .groupBy("meter_id", R.reading_date().alias("reading_date"))
             .agg(rnd(F.min("power_kw"), 4).alias("base_load_kw")))
    return top_k(daily, n, F.col("base_load_kw").asc_nulls_last(), F.col("meter_id"), F.col("reading_date"))


def q17_voltage_trend(df: DataFrame) -> DataFrame:
    return (df.groupBy("year", "month")
            .agg(rnd(F.min("avg_voltage"), 1).alias("min_v"), rnd(F.avg("avg_voltage"), 1).alias("avg_v"),
                 rnd(F.max("avg_voltage"), 1).alias("max_v"))
            .orderBy("year", "month"))


def q20_freq_stability(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Frequency mean / sample deviation per meter, outages (0 Hz) excluded."""
    lo, hi = rules.frequency_band
    return (df.filter(F.col("frequency_hz") > 0)
            .groupBy("meter_id")
            .agg(rnd(F.avg("frequency_hz"), 3).alias("avg_hz"),
                 rnd(F.stddev_samp("frequency_hz"), 3).alias("stddev_hz"),
                 F.count_if(~F.col("frequency_hz").between(lo, hi)).alias("out_of_band_readings"))
            .orderBy(F.col("out_of_band_readings").desc(), "meter_id"))


def q22_high_load(df: DataFrame, n: int = 50) -> DataFrame:
    daily = (df.filter(F.col("current_band") == "HIGH_LOAD")
             .groupBy("meter_id", R.reading_date().alias("reading_date"))
             .agg(F.count(F.lit(1)).alias("high_load_intervals"), rnd(F.max("avg_current"), 2).alias("peak_amps")))
    return top_k(daily, n, F.col("high_load_intervals").desc(), F.col("meter_id"), F.col("reading_date"))


def q26_load_factor(df: DataFrame, n: int = 50) -> DataFrame:
    """avg / peak demand per meter-month; NULL (no demand at all) sorts last."""
    m = (df.groupBy("meter_id", "year", "month")
         .agg(rnd(safe_div(F.avg("power_kw"), F.max("power_kw")), 3).alias("load_factor")))
    return top_k(m, n, F.col("load_factor").asc_nulls_last(), F.col("meter_id"), F.col("year"), F.col("month"))


def q27_sag_swell(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Daily fleet counts: swell (> 240 V), sag (1–200 V inclusive), outage (0 V)."""
    v = F.col("avg_voltage")
    return (df.groupBy(R.reading_date().alias("reading_date"))
            .agg(F.count_if(v > rules.over_voltage).alias("swell_readings"),
                 F.count_if(v.between(1, rules.low_voltage_min)).alias("sag_readings"),
                 F.count_if(v == 0).alias("outage_readings"))
            .orderBy("reading_date"))
