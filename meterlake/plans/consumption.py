"""Consumption queries (Q01–Q05, Q10, Q16, Q21, Q23, Q28)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd, safe_div
from ..operators import grains
from ..rules import RULES, Rules
from ..session import ensure_checkpoint_dir
from .common import top_k


def q01_daily_kwh(df: DataFrame) -> DataFrame:
    """Daily energy per meter (the reference titles it 'average', it is the daily sum)."""
    return (grains.daily(df, date_alias="reading_date")
            .select("meter_id", "reading_date", rnd("kwh", 3).alias("daily_kwh"))
            .orderBy("meter_id", "reading_date"))


def q02_fleet_daily_avg(df: DataFrame) -> DataFrame:
    """Average over meters of each meter's daily total."""
    return (grains.daily(df, date_alias="reading_date")
            .groupBy("reading_date").agg(rnd(F.avg("kwh"), 3).alias("avg_daily_kwh_per_meter"))
            .orderBy("reading_date"))


def q03_monthly_kwh(df: DataFrame) -> DataFrame:
    return (grains.monthly(df)
            .select("meter_id", "year", "month", rnd("kwh", 2).alias("monthly_kwh"))
            .orderBy("year", "month", "meter_id"))


def q04_top_consumers(df: DataFrame, n: int = 10) -> DataFrame:
    totals = df.groupBy("meter_id").agg(rnd(F.sum("energy_kwh"), 2).alias("total_kwh"))
    return top_k(totals, n, F.col("total_kwh").desc_nulls_last(), F.col("meter_id"))


def q05_peak_hours(df: DataFrame) -> DataFrame:
    return (df.groupBy("hour").agg(rnd(F.sum("energy_kwh"), 2).alias("total_kwh"))
            .orderBy(F.col("total_kwh").desc(), "hour"))


def q10_weekend_split(df: DataFrame) -> DataFrame:
    return df.groupBy("is_weekend").agg(
        rnd(F.sum("energy_kwh"), 2).alias("total_kwh"),
        rnd(F.avg("energy_kwh"), 5).alias("avg_interval_kwh"))


def q16_trend_7d_ma(df: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """Fleet daily total with a trailing moving average over ``days`` rows, or with ``calendar=True`` over the
    days present among the last ``days`` calendar days.

    The window has no partition key, which is only acceptable because it runs
    on the fleet-day series (one row per calendar day), never on readings.
    """
    if calendar:
        w = Window.orderBy(grains.day_number("d")).rangeBetween(-(days - 1), 0)
    else:
        w = Window.orderBy("d").rowsBetween(-(days - 1), 0)
    return (grains.fleet_daily(df)
            .select("d", rnd("kwh", 2).alias("daily_kwh"), rnd(F.avg("kwh").over(w), 2).alias("kwh_7day_ma"))
            .orderBy("d"))


def q21_heatmap(df: DataFrame, wide: bool = False) -> DataFrame:
    """Day-of-week × hour energy, long form; ``wide=True`` pivots hours 0–23 into columns h00…h23.

    The pivot runs on the aggregated long form (at most 7 × 24 rows) with the
    hour values listed, so Spark needs no extra pass to discover them.
    """
    long = df.groupBy("day_of_week", "hour").agg(rnd(F.sum("energy_kwh"), 2).alias("total_kwh"))
    if not wide:
        return long.orderBy("day_of_week", "hour")
    wide_df = long.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.first("total_kwh"))
    return wide_df.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)]).orderBy("day_of_week")


def q23_mom_growth(df: DataFrame, calendar: bool = False) -> DataFrame:
    """Month-over-month change against the previous month present for the meter; with ``calendar=True`` only
    against the calendar month before."""
    w = Window.partitionBy("meter_id").orderBy("year", "month")
    prev = F.lag("kwh").over(w)
    if calendar:
        number = F.col("year") * 12 + F.col("month")
        prev = F.when(number - F.lag(number).over(w) == 1, prev)
    m = grains.monthly(df).withColumn("_prev", prev)
    return (m.select("meter_id", "year", "month", rnd("kwh", 2).alias("kwh"),
                     rnd(safe_div(F.lit(100.0) * (F.col("kwh") - F.col("_prev")), F.col("_prev")), 1)
                     .alias("mom_growth_pct"))
            .orderBy("meter_id", "year", "month"))


def q28_completeness(df: DataFrame, rules: Rules = RULES, threshold_pct: float = 90.0,
                     n: int | None = 100, fill_calendar: bool = False) -> DataFrame:
    """Meter-days with fewer readings than ``threshold_pct`` of the nominal day.

    ``fill_calendar=True`` also reports days without any reading, between each
    meter's first and last day (generated per meter with ``sequence``).
    """
    expected = rules.readings_per_day
    threshold = expected * threshold_pct / 100.0
    counts = df.groupBy("meter_id", R.reading_date().alias("reading_date")).agg(F.count(F.lit(1)).alias("readings"))
    if fill_calendar:
        ensure_checkpoint_dir(df.sparkSession)
        counts = counts.checkpoint(eager=True)   # meter-day grain, read by the span and by the join
        span = counts.groupBy("meter_id").agg(F.min("reading_date").alias("_a"), F.max("reading_date").alias("_b"))
        days = span.select("meter_id", F.explode(F.sequence("_a", "_b")).alias("reading_date"))
        counts = (days.join(counts, ["meter_id", "reading_date"], "left")
                  .select("meter_id", "reading_date", F.coalesce("readings", F.lit(0).cast("bigint")).alias("readings")))
    flagged = (counts.filter(F.col("readings") < threshold)
               .withColumn("completeness_pct", rnd(F.lit(100.0) * F.col("readings") / F.lit(float(expected)), 1)))
    return top_k(flagged.select("meter_id", "reading_date", "readings", "completeness_pct"), n,
                 F.col("completeness_pct").asc(), F.col("meter_id"), F.col("reading_date"))
