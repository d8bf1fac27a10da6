"""Curation: type, reject, de-duplicate and enrich raw readings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import readings as R
from ..functions.wallclock import parse_wallclock
from ..rules import BASE_COLUMNS, KEY, MEASURES, RULES, Rules


def typed_readings(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Cast the six base columns; unparseable values become NULL (never raise)."""
    types = dict(df.dtypes)
    ts = F.col("reading_ts")
    if types["reading_ts"] == "string":
        ts = parse_wallclock(F.trim(ts), rules.timestamp_format)
    elif types["reading_ts"] != "timestamp_ntz":
        ts = ts.try_cast("timestamp_ntz")
    cols = [ts.alias("reading_ts")]
    for m in MEASURES:
        c = F.col(m)
        cols.append((F.trim(c) if types[m] == "string" else c).try_cast("double").alias(m))
    cols.append(F.trim(F.col("meter_id").cast("string")).alias("meter_id"))
    extra = [F.col(c) for c in df.columns if c not in BASE_COLUMNS]
    return df.select(*cols, *extra)


def drop_nulls(df: DataFrame, subset=BASE_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(subset))


def not_null(cols=BASE_COLUMNS) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def in_range(rules: Rules = RULES) -> Column:
    """Closed-range check on all four measures (NaN fails: it sorts above every bound)."""
    cond = F.lit(True)
    for c, (lo, hi) in rules.ranges().items():
        cond = cond & F.col(c).between(lo, hi)
    return cond


def range_filter(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    return df.filter(in_range(rules))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop identical rows (hash aggregate with map-side combine)."""
    return df.distinct()


def dedup_key(df: DataFrame, key=KEY, order=MEASURES) -> DataFrame:
    """One row per key; the survivor is the lowest by ``order`` (deterministic).

    Expressed as ``min(struct(order…))`` per key. Nearly every key is there
    once, so rows are shuffled as they are: sorting the whole input of a map
    task for a partial aggregate that collapses nothing spilled it to disk.
    A task then goes through its sorted rows as a stream, however many copies
    a key has.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_keep")
    return (df.repartition(*key).groupBy(*key).agg(packed)
              .select(*key, *[F.col(f"_keep.{c}").alias(c) for c in (*order, *rest)])
              .select(*df.columns))


def enrich(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Time attributes, power, bands, health score and status in one projection.

    Existing ``year`` / ``month`` columns are passed through unchanged, so an
    order or partitioning already established on them survives.
    """
    t = R.time_attributes("reading_ts")
    keep = [c for c in ("year", "month") if c in df.columns]
    for c in keep:
        t[c] = F.col(c)
    base = df.select(*BASE_COLUMNS, *keep, R.power_kw(rules).alias("power_kw"))
    return base.select(
        *BASE_COLUMNS,
        t["day"].alias("day"), t["hour"].alias("hour"), t["day_of_week"].alias("day_of_week"),
        t["is_weekend"].alias("is_weekend"), "power_kw",
        R.voltage_band(rules).alias("voltage_band"),
        R.current_band(rules).alias("current_band"),
        R.power_band(rules, None if rules.power_band_on_rounded
                     else F.col("avg_voltage") * F.col("avg_current") / F.lit(1000.0)).alias("power_band"),
        R.health_score(rules).alias("health_score"),
        R.health_status(rules).alias("health_status"),
        t["year"].alias("year"), t["month"].alias("month"),
    )


def clean(df: DataFrame, rules: Rules = RULES, order: str = "filter_first") -> DataFrame:
    """Typed, non-null, in-range, one row per (meter_id, reading_ts).

    ``order="filter_first"`` (default) rejects bad rows before de-duplicating,
    so a key with one bad and one good copy keeps the good one. The checks
    are folded into the de-duplicating aggregate (``min`` skips the NULL that
    an invalid row contributes), so each raw value is parsed exactly once; a
    filter under the typing projection would be pushed below it and re-parse
    every column. Only rows without a key, which the shuffle by key would
    gather in one task, are left out before it. ``order="dedup_first"``
    reproduces the batch script's order.
    """
    typed = typed_readings(df, rules)
    if order == "filter_first":
        valid = not_null() & in_range(rules)
        packed = F.min(F.when(valid, F.struct(*MEASURES))).alias("_keep")
        return (drop_nulls(typed, KEY).repartition(*KEY).groupBy(*KEY).agg(packed)
                     .filter(F.col("_keep").isNotNull())
                     .select("reading_ts", *[F.col(f"_keep.{c}").alias(c) for c in MEASURES], "meter_id"))
    if order == "dedup_first":
        return range_filter(dedup_key(drop_nulls(typed)), rules)
    raise ValueError(f"unknown order {order!r}")


def curate(df: DataFrame, rules: Rules = RULES, order: str = "filter_first") -> DataFrame:
    """Raw readings (curated names) → curated table rows."""
    return enrich(clean(df.select(*BASE_COLUMNS), rules, order), rules)
