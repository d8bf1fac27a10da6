"""Dashboard data feeds (D01–D20) over the hourly rollup, plus filters.

Feeds marked "curated" need reading-level columns the rollup does not keep
(bands, status per reading, zero-voltage readings).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd, safe_div
from ..operators.anomaly import anomaly_series
from ..operators.regression import forecast_grouped
from ..rules import RULES, Rules
from ..session import ensure_checkpoint_dir
from ..sources.curated import partition_predicate
from .common import top_k


def _day() -> F.Column:
    return F.to_date("hour_ts")


def _month_start() -> F.Column:
    return F.trunc(F.to_date("hour_ts"), "month")


def d01_kpi_tiles(rollup: DataFrame) -> DataFrame:
    """Total / healthy / warning / critical meters by worst hourly status; averages of hourly values.

    Per-meter flags first (partial aggregation), then one global row; the
    distinct-day count is its own one-row aggregate.
    """
    s = F.col("worst_health_status")
    pm = rollup.groupBy("meter_id").agg(
        F.max((s == "HEALTHY").cast("int")).alias("h"), F.max((s == "WARNING").cast("int")).alias("w"),
        F.max((s == "CRITICAL").cast("int")).alias("c"), F.sum("energy_kwh").alias("e"),
        F.sum("avg_voltage").alias("v"), F.sum("avg_current").alias("a"), F.count(F.lit(1)).alias("n"))
    days = rollup.agg(F.count_distinct(_day())).scalar()
    tot = pm.agg(F.count(F.lit(1)).alias("total_meters"), F.sum("h").cast("bigint").alias("healthy_meters"),
                 F.sum("w").cast("bigint").alias("warning_meters"), F.sum("c").cast("bigint").alias("critical_meters"),
                 F.sum("e").alias("_e"), F.sum("v").alias("_v"), F.sum("a").alias("_a"), F.sum("n").alias("_n"))
    return tot.select(
        "total_meters", "healthy_meters", "warning_meters", "critical_meters",
        rnd(F.col("_e") / days / F.col("total_meters"), 3).alias("avg_daily_kwh"),
        rnd(F.col("_v") / F.col("_n"), 2).alias("avg_voltage"),
        rnd(F.col("_a") / F.col("_n"), 3).alias("avg_current"))


def d02_health_gauge(rollup: DataFrame, red_below: float = 60.0, green_above: float = 80.0) -> DataFrame:
    g = rollup.agg(rnd(F.avg("health_score"), 2).alias("avg_health_score"))
    sc = F.col("avg_health_score")
    return g.select("avg_health_score",
                    F.when(sc < red_below, "red").when(sc > green_above, "green").otherwise("amber").alias("gauge_band"))


def d03_health_pie(rollup: DataFrame) -> DataFrame:
    """Distinct meters per worst hourly status (a meter can sit in several slices)."""
    return (rollup.groupBy("worst_health_status").agg(F.count_distinct("meter_id").alias("meters"))
            .orderBy(F.col("meters").desc(), "worst_health_status"))


def d06_status_bar(rollup: DataFrame) -> DataFrame:
    """Bar of meters by worst status: the same measure as the pie."""
    return d03_health_pie(rollup)


def _monthly(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(_month_start().alias("month_start")).agg(F.sum("energy_kwh").alias("kwh"))


def _daily(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(_day().alias("day")).agg(F.sum("energy_kwh").alias("kwh"))


def d04_monthly_line(rollup: DataFrame) -> DataFrame:
    return _monthly(rollup).select("month_start", rnd("kwh", 3).alias("total_kwh")).orderBy("month_start")


def month_index(date_col: str) -> F.Column:
    """Months since year 0 (year·12 + month − 1): consecutive months are consecutive integers."""
    return F.year(date_col) * 12 + F.month(date_col) - 1


def month_from_index(idx: str) -> F.Column:
    return F.make_date(F.expr(f"{idx} div 12").cast("int"), (F.col(idx) % 12 + 1).cast("int"), F.lit(1))


def _monthly_forecast(rollup: DataFrame, horizon: int, level: float) -> DataFrame:
    """``rollup`` may also be the monthly series itself (month_start, kwh)."""
    monthly = rollup if "hour_ts" not in rollup.columns else _monthly(rollup)
    m = monthly.select(month_index("month_start").alias("x"), "kwh")
    fc = forecast_grouped(m, [], "x", "kwh", horizon, level)
    return fc.select(month_from_index("x_future").alias("period"), "step", "forecast", "lower", "upper")


def d05_monthly_forecast(rollup: DataFrame, horizon: int = 3, level: float = 0.90) -> DataFrame:
    """Fleet monthly kWh, ``horizon`` months ahead with a ``level`` interval (OLS on month index)."""
    return (_monthly_forecast(rollup, horizon, level)
            .select("period", "step", rnd("forecast", 2).alias("forecast_kwh"),
                    rnd("lower", 2).alias("lower_kwh"), rnd("upper", 2).alias("upper_kwh")).orderBy("period"))


def d07_daily_line(rollup: DataFrame) -> DataFrame:
    return _daily(rollup).select("day", rnd("kwh", 3).alias("total_kwh")).orderBy("day")


def d08_daily_forecast(rollup: DataFrame, horizon: int = 14, level: float = 0.90) -> DataFrame:
    d = _daily(rollup).select(F.unix_date("day").alias("x"), "kwh")
    fc = forecast_grouped(d, [], "x", "kwh", horizon, level)
    return fc.select(F.date_from_unix_date(F.col("x_future").cast("int")).alias("period"), "step",
                     rnd("forecast", 2).alias("forecast_kwh"), rnd("lower", 2).alias("lower_kwh"),
                     rnd("upper", 2).alias("upper_kwh")).orderBy("period")


def d09_daily_anomalies(rollup: DataFrame, window: int = 30, sigmas: float = 3.0, n: int = 10) -> DataFrame:
    """Top fleet-day anomalies: A1's rolling z-score on the fleet daily series."""
    return anomaly_series(_daily(rollup), [], "day", "kwh", window, sigmas, 2, n)


def d10_top_consumers(rollup: DataFrame, n: int = 10) -> DataFrame:
    t = rollup.groupBy("meter_id").agg(rnd(F.sum("energy_kwh"), 2).alias("total_kwh"))
    return top_k(t, n, F.col("total_kwh").desc_nulls_last(), F.col("meter_id"))


def d11_heatmap(rollup: DataFrame) -> DataFrame:
    """day_of_week × hour kWh with a Monday-first ordering column."""
    return (rollup.groupBy("day_of_week", R.day_of_week_number("hour_ts").alias("weekday"), "hour")
            .agg(rnd(F.sum("energy_kwh"), 2).alias("total_kwh")).orderBy("weekday", "hour"))


def d12_weekend_trend(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy(_day().alias("day"), "is_weekend").agg(rnd(F.sum("energy_kwh"), 3).alias("total_kwh"))
            .orderBy("day"))


def d13_power_combo(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("hour").agg(rnd(F.avg("avg_power_kw"), 3).alias("avg_power_kw"),
                                       rnd(F.max("peak_power_kw"), 3).alias("max_power_kw")).orderBy("hour"))


def d14_forecast_narrative(rollup: DataFrame, level: float = 0.90) -> DataFrame:
    """One row: next month's expected kWh against the last observed month, plus a sentence.

    The fleet monthly series (one row per month) is checkpointed once; the
    forecast and the last-month lookup both read it.
    """
    ensure_checkpoint_dir(rollup.sparkSession)
    monthly = _monthly(rollup).checkpoint(eager=True)
    nxt = _monthly_forecast(monthly, 1, level).select(F.col("period").alias("next_period"),
                                                      F.col("forecast").alias("forecast_kwh"))
    last = monthly.agg(F.max_by(F.struct("month_start", "kwh"), "month_start")).scalar()
    last_period, last_kwh = last.getField("month_start"), last.getField("kwh")
    change = rnd(safe_div(F.lit(100.0) * (F.col("forecast_kwh") - last_kwh), last_kwh), 1)
    out = nxt.select(
        "next_period", rnd("forecast_kwh", 1).alias("expected_kwh"), last_period.alias("last_period"),
        rnd(last_kwh, 1).alias("last_period_kwh"), change.alias("change_pct"))
    text = F.concat(F.lit("Expected consumption next month: "),
                    F.col("expected_kwh").cast("decimal(20,1)").cast("string"), F.lit(" kWh ("),
                    F.coalesce(F.col("change_pct").cast("decimal(20,1)").cast("string"), F.lit("n/a")),
                    F.lit("% vs last month)"))
    return out.withColumn("narrative", text)


def d15_voltage_trend(rollup: DataFrame, rules: Rules = RULES) -> DataFrame:
    d = rollup.groupBy(_day().alias("day")).agg(rnd(F.avg("avg_voltage"), 2).alias("avg_voltage"))
    return d.select("day", "avg_voltage", (F.col("avg_voltage") > rules.over_voltage).alias("above_240"),
                    (F.col("avg_voltage") < rules.low_voltage_min).alias("below_200")).orderBy("day")


def d16_current_trend(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(_day().alias("day")).agg(rnd(F.avg("avg_current"), 3).alias("avg_current")).orderBy("day")


def d17_voltage_band_bar(curated: DataFrame) -> DataFrame:
    """Readings per voltage band (curated: the rollup keeps no band)."""
    return (curated.groupBy("voltage_band").agg(F.count(F.lit(1)).alias("readings"))
            .orderBy(F.col("readings").desc(), "voltage_band"))


def d18_unhealthy_table(curated: DataFrame, n: int = 20) -> DataFrame:
    """Lowest mean score meters with % CRITICAL and % WARNING readings (curated)."""
    s = F.col("health_status")
    m = curated.groupBy("meter_id").agg(
        rnd(F.avg("health_score"), 1).alias("avg_health_score"),
        rnd(F.lit(100.0) * F.avg((s == "CRITICAL").cast("double")), 2).alias("pct_critical"),
        rnd(F.lit(100.0) * F.avg((s == "WARNING").cast("double")), 2).alias("pct_warning"))
    return top_k(m, n, F.col("avg_health_score").asc_nulls_last(), F.col("meter_id"))


def d19_health_trend(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy(_month_start().alias("month_start"))
            .agg(rnd(F.avg("health_score"), 2).alias("avg_health_score")).orderBy("month_start"))


def d20_outage_by_meter(curated: DataFrame, rules: Rules = RULES, n: int = 20) -> DataFrame:
    """Outage hours per meter from zero-voltage readings (curated: hourly rows would undercount)."""
    m = (curated.filter(F.col("avg_voltage") == 0).groupBy("meter_id")
         .agg(rnd(F.count(F.lit(1)) * F.lit(float(rules.interval_minutes)) / F.lit(60.0), 2).alias("outage_hours")))
    return top_k(m, n, F.col("outage_hours").desc(), F.col("meter_id"))


def dashboard_filter(rollup: DataFrame, since=None, until=None, meters: Sequence[str] | DataFrame | None = None,
                     towns: Sequence[str] | None = None, statuses: Sequence[str] | None = None) -> DataFrame:
    """The sheet filters: hour_ts range [since, until), meters, towns, worst status.

    A meter selection given as a DataFrame (an unbounded list) is applied as a
    semi join; a literal list becomes an ``IN`` predicate pushed to the scan.
    The time range also limits year and month, the partitions of the table.
    """
    out = rollup
    within = partition_predicate(since, until, ts="hour_ts")
    if within is not None:
        out = out.filter(within)
    if isinstance(meters, DataFrame):
        out = out.join(meters.select("meter_id").distinct(), "meter_id", "left_semi")
    elif meters:
        out = out.filter(F.col("meter_id").isin(list(meters)))
    if towns:
        out = out.filter(R.in_towns(towns))
    if statuses:
        out = out.filter(F.col("worst_health_status").isin(list(statuses)))
    return out


def town_view(df: DataFrame, towns: Sequence[str], name: str = "town_view") -> DataFrame:
    """Row-level restriction by town, registered as a temporary view ``name``."""
    df.filter(R.in_towns(towns)).createOrReplaceTempView(name)
    return df.sparkSession.table(name)
