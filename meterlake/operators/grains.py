"""Reusable aggregation grains over curated readings.

All of them are hash aggregations with map-side partial aggregation, so a
meter (or a day) holding a large share of the rows is collapsed inside each
map task before anything is shuffled. The two rollups may have nearly as many
groups as there are rows, and a map task's hash table of them outgrows its
memory: for the jobs that write them (``laid_out=True``) rows are dealt by
ranges of their keys instead, sorted, and aggregated as a stream.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import readings as R
from ..rules import STATUS_SEVERITY


def day_of(df: DataFrame) -> F.Column:
    """Calendar day of a row of the curated table, the hourly rollup or the daily rollup."""
    if "reading_ts" in df.columns:
        return R.reading_date("reading_ts")
    if "hour_ts" in df.columns:
        return F.to_date("hour_ts")
    return F.col("reading_date")


def day_number(day: str) -> F.Column:
    """Days since 1970-01-01, for frames over calendar days."""
    return F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))


def daily(df: DataFrame, value: str = "energy_kwh", alias: str = "kwh", date_alias: str = "d") -> DataFrame:
    """Per meter-day sum: (meter_id, d, kwh).

    Accepts the curated table or either rollup (sums of sums): a rollup holds
    20× (hourly) or 480× (daily) fewer rows than the readings. The daily rollup
    has one row for nearly every group, so its rows are dealt by meter as they
    are, sorted and added up as a stream (``in_ranges`` tells of the struct);
    the result lies by meter and day, and a window over a meter's days
    needs no second shuffle or sort.
    """
    if "reading_date" in df.columns:
        rows = df.select("meter_id", day_of(df).alias(date_alias), F.col(value).alias("_value")).repartition("meter_id")
        sums = rows.groupBy("meter_id", date_alias).agg(F.sum("_value").alias(alias), F.min(F.struct("meter_id")).alias("_rows"))
        return sums.select("meter_id", date_alias, F.when(F.col("_rows").isNotNull(), F.col(alias)).alias(alias))
    return df.groupBy("meter_id", day_of(df).alias(date_alias)).agg(F.sum(value).alias(alias))


def monthly(df: DataFrame, value: str = "energy_kwh", alias: str = "kwh") -> DataFrame:
    """Per meter-month sum: (meter_id, year, month, kwh); curated table or either rollup."""
    return df.groupBy("meter_id", "year", "month").agg(F.sum(value).alias(alias))


def fleet_daily(df: DataFrame, value: str = "energy_kwh", alias: str = "kwh", date_alias: str = "d") -> DataFrame:
    """Fleet total per calendar day: (d, kwh). At most one row per day of data."""
    return df.groupBy(day_of(df).alias(date_alias)).agg(F.sum(value).alias(alias))


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ranges of the keys: a task holds whole groups, and few months.

    An aggregate over these keys with a struct among its buffers (Spark keeps no hash table for such) goes
    through the sorted rows as a stream, and its result lies in the order of the keys.
    """
    return df.repartitionByRange(*keys)


def daily_rollup(df: DataFrame, laid_out: bool = False) -> DataFrame:
    """Meter × day pre-aggregate: meter_id, reading_date, year, month, energy_kwh, readings.

    Serves the day- and month-grain queries (Q01–Q03, Q16, Q23, P1, P2, A1,
    A2) at 1/480 of the readings; built from the curated table or the hourly
    rollup. With ``laid_out=True`` it comes out by year, month and meter.
    """
    if laid_out:
        date, n = day_of(df), F.col("readings") if "readings" in df.columns else F.lit(1)
        rows = df.select(F.year(date).alias("year"), F.month(date).alias("month"), "meter_id", F.dayofmonth(date).alias("_day"),
                         date.alias("reading_date"), "energy_kwh", n.cast("bigint").alias("readings"))
        keys = ("year", "month", "meter_id", "_day")
        agg = in_ranges(rows, *keys).groupBy(*keys).agg(
            F.sum("energy_kwh").alias("energy_kwh"), F.sum("readings").alias("readings"), F.min(F.struct("reading_date")).alias("_d"))
        return agg.select("meter_id", F.col("_d.reading_date").alias("reading_date"), "year", "month", "energy_kwh", "readings")
    n = F.sum("readings") if "readings" in df.columns else F.count(F.lit(1))
    agg = df.groupBy("meter_id", day_of(df).alias("reading_date")).agg(
        F.sum("energy_kwh").alias("energy_kwh"), n.alias("readings"))
    return agg.select("meter_id", "reading_date", F.year("reading_date").alias("year"),
                      F.month("reading_date").alias("month"), "energy_kwh", "readings")


def scaled_units(col: str, decimals: int) -> F.Column:
    """A non-negative value with ``decimals`` places as a BIGINT count of 10^-decimals units.

    ``x·10^d`` lies within float noise of an integer, so adding 0.5 and
    flooring recovers it exactly (cheaper than ``round``, which builds a
    BigDecimal per row).
    """
    return F.floor(F.col(col) * F.lit(10.0 ** decimals) + F.lit(0.5)).cast("bigint")


def scaled_sum(col: str, decimals: int) -> F.Column:
    """Exact sum of a column holding ``decimals``-place values, as a BIGINT in 10^-decimals units.

    Float sums depend on the order of addition; an integer sum does not, so
    the result is identical on every run and every engine.
    """
    return F.sum(scaled_units(col, decimals))


def fleet_interval(df: DataFrame, power_decimals: int = 4) -> DataFrame:
    """Fleet demand per reading timestamp: (reading_ts, fleet_kw_units, fleet_kw, meters).

    ``fleet_kw_units`` is the exact sum of ``power_kw`` in 10^-4 kW.
    """
    units = 10.0 ** power_decimals
    return (df.groupBy("reading_ts")
              .agg(scaled_sum("power_kw", power_decimals).alias("fleet_kw_units"),
                   F.count(F.lit(1)).alias("meters"))
              .withColumn("fleet_kw", F.col("fleet_kw_units").cast("double") / F.lit(units)))


def severity_rank(status: str = "health_status") -> F.Column:
    """0 for the worst status (CRITICAL) … 4 for HEALTHY."""
    expr = F.lit(len(STATUS_SEVERITY))
    for i, s in reversed(list(enumerate(STATUS_SEVERITY))):
        expr = F.when(F.col(status) == s, F.lit(i)).otherwise(expr)
    return expr


def worst_status_key(score: str = "health_score", status: str = "health_status") -> F.Column:
    """BIGINT ordering (score in 10^-4 points, then severity): min() of it is the worst reading.

    A fixed-width key keeps the aggregate hash-based (a struct or string
    buffer would force a sort-based aggregate).
    """
    return F.round(F.col(score) * F.lit(10000.0)).cast("bigint") * F.lit(10) + severity_rank(status).cast("bigint")


def status_from_key(key: F.Column) -> F.Column:
    sev = key % F.lit(10)
    expr = F.lit(None).cast("string")
    for i, s in reversed(list(enumerate(STATUS_SEVERITY))):
        expr = F.when(sev == i, F.lit(s)).otherwise(expr)
    return expr


def hourly_rollup(df: DataFrame, power_decimals: int = 4, laid_out: bool = False) -> DataFrame:
    """Meter × hour pre-aggregate feeding the dashboard (one row per meter_id, hour_ts).

    Grouped on the two real keys only; the calendar columns depend on
    ``hour_ts`` and are derived after the aggregation, on 20× fewer rows.
    ``avg_power_kw`` comes from an exact integer sum of the 4-decimal
    ``power_kw`` values. ``worst_health_status`` is the status of the lowest
    score; equal scores resolve to the more severe status. With
    ``laid_out=True`` it comes out by year, month and meter, and the groups
    are those of (year, month, meter_id, hour_ts), which are the same.
    """
    units = 10.0 ** power_decimals
    t = R.time_attributes("hour_ts")
    worst, keys = worst_status_key(), ("meter_id", "hour_ts")
    df = df.select("meter_id", R.hour_ts().alias("hour_ts"), "energy_kwh", "avg_voltage", "avg_current", "power_kw",
                   "health_score", "health_status")
    if laid_out:
        keys = ("year", "month", *keys)
        df = in_ranges(df.select("*", t["year"].alias("year"), t["month"].alias("month")), *keys)
        worst = F.struct(worst.alias("key"))
    agg = (df.groupBy(*keys)
             .agg(F.sum("energy_kwh").alias("energy_kwh"),
                  F.avg("avg_voltage").alias("avg_voltage"),
                  F.avg("avg_current").alias("avg_current"),
                  scaled_sum("power_kw", power_decimals).alias("_pw_units"),
                  F.count(F.lit(1)).alias("readings"),
                  F.max("power_kw").alias("peak_power_kw"),
                  F.avg("health_score").alias("health_score"),
                  F.min(worst).alias("_worst")))
    return agg.select(
        "meter_id", *(["year", "month"] if laid_out else [t["year"].alias("year"), t["month"].alias("month")]), t["day"].alias("day"),
        t["hour"].alias("hour"), t["day_of_week"].alias("day_of_week"), t["is_weekend"].alias("is_weekend"),
        "hour_ts", "energy_kwh", "avg_voltage", "avg_current",
        (F.col("_pw_units").cast("double") / F.col("readings") / F.lit(units)).alias("avg_power_kw"),
        "peak_power_kw", "health_score",
        status_from_key(F.col("_worst.key") if laid_out else F.col("_worst")).alias("worst_health_status"),
        "readings",
    )
