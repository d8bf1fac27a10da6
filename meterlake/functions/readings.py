"""Per-reading derived columns: time attributes, power, bands, health."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..rules import RULES, Rules
from .numeric import rnd


def reading_date(ts: str = "reading_ts") -> Column:
    return F.to_date(F.col(ts))


def hour_ts(ts: str = "reading_ts") -> Column:
    """Start of the wall-clock hour, timestamp_ntz, independent of the session zone."""
    midnight = F.to_date(F.col(ts)).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.hour(F.col(ts)), midnight)


def day_of_week_number(ts: str = "reading_ts") -> Column:
    """ISO weekday, Monday=1 .. Sunday=7 (dashboard ordering Mon→Sun)."""
    return (F.dayofweek(F.col(ts)) + F.lit(5)) % F.lit(7) + F.lit(1)


# fixed values: English day names as produced by date_format(ts, 'EEEE'), indexed by dayofweek (Sunday=1)
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_name(ts: str = "reading_ts") -> Column:
    """Same text as ``date_format(ts, 'EEEE')`` by array lookup (no formatter per row)."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.dayofweek(F.col(ts)))


def time_attributes(ts: str = "reading_ts") -> dict[str, Column]:
    t = F.col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "day_of_week": day_name(ts),
        "is_weekend": F.dayofweek(t).isin(1, 7),   # Sunday=1, Saturday=7
    }


def power_kw(rules: Rules = RULES) -> Column:
    """Apparent power V·I/1000 (power factor ~1), rounded."""
    return rnd(F.col("avg_voltage") * F.col("avg_current") / F.lit(1000.0), rules.power_decimals)


def voltage_band(rules: Rules = RULES) -> Column:
    v = F.col("avg_voltage")
    return (F.when(v > rules.over_voltage, "OVER_VOLTAGE")
            .when(v >= rules.normal_voltage_min, "NORMAL")
            .when(v >= rules.low_voltage_min, "LOW")
            .otherwise("CRITICAL_LOW"))


def current_band(rules: Rules = RULES) -> Column:
    a = F.col("avg_current")
    return (F.when(a > rules.high_load_amps, "HIGH_LOAD")
            .when(a >= rules.medium_load_amps, "MEDIUM_LOAD")
            .when(a > 0, "LIGHT_LOAD")
            .otherwise("NO_LOAD"))


def power_band(rules: Rules = RULES, power: Column | None = None) -> Column:
    p = F.col("power_kw") if power is None else power
    return (F.when(p > rules.high_power_kw, "HIGH")
            .when(p >= rules.medium_power_kw, "MEDIUM")
            .when(p > 0, "LOW")
            .otherwise("IDLE"))


def _dead_meter(rules: Rules) -> Column:
    return (F.col("energy_kwh") <= rules.dead_kwh_max) & (F.col("avg_voltage") > rules.dead_voltage_min)


def health_score(rules: Rules = RULES) -> Column:
    v, a, hz = F.col("avg_voltage"), F.col("avg_current"), F.col("frequency_hz")
    lo, hi = rules.frequency_band
    voltage_pen = (F.when(v > rules.over_voltage, F.lit(rules.penalty_over_voltage))
                   .when(v < rules.low_voltage_min, F.lit(rules.penalty_critical_low))
                   .when(v < rules.normal_voltage_min, F.lit(rules.penalty_low_voltage))
                   .otherwise(F.lit(0.0)))
    current_pen = F.when(a > rules.high_load_amps, F.lit(rules.penalty_over_current)).otherwise(F.lit(0.0))
    freq_pen = F.when((hz < lo) | (hz > hi), F.lit(rules.penalty_frequency)).otherwise(F.lit(0.0))
    dead_pen = F.when(_dead_meter(rules), F.lit(rules.penalty_dead_meter)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(rules.score_floor),
                      F.lit(rules.score_start) - voltage_pen - current_pen - freq_pen - dead_pen)


def health_status(rules: Rules = RULES) -> Column:
    v, a = F.col("avg_voltage"), F.col("avg_current")
    return (F.when(v > rules.over_voltage, "CRITICAL")
            .when(v < rules.low_voltage_min, "WARNING")
            .when(a > rules.high_load_amps, "HIGH_LOAD")
            .when(_dead_meter(rules), "POSSIBLE_METER_ISSUE")
            .otherwise("HEALTHY"))


def town(meter: str = "meter_id") -> Column:
    """Two-letter town prefix of the meter id (BR, MH)."""
    return F.substring(F.col(meter), 1, 2)


def in_towns(towns, meter: str = "meter_id") -> Column:
    """``town() IN towns`` as prefixes, which reach the Parquet reader; an empty list is no row."""
    cond = F.lit(False)
    for t in towns:
        cond = cond | (F.col(meter).startswith(t) if len(t) == 2 else town(meter) == t)
    return cond
