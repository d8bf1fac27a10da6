"""Outage spells: runs of consecutive zero-voltage readings (gaps and islands)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import rnd
from ..rules import RULES, Rules


def _islands(df: DataFrame, keys: list[str], start: str, end: str, gap_s: int) -> DataFrame:
    """Adds ``_island``: a running id that grows when a row starts more than ``gap_s`` after the previous end."""
    w = Window.partitionBy(*keys).orderBy(start)
    prev_end = F.lag(end).over(w)
    new = F.when(prev_end.isNull() | (F.timestamp_diff("SECOND", prev_end, F.col(start)) > gap_s), 1).otherwise(0)
    return (df.withColumn("_new", new)
              .withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def outage_spells(df: DataFrame, rules: Rules = RULES, min_readings: int = 1) -> DataFrame:
    """One row per spell: meter_id, spell_start, spell_end, readings, est_hours.

    Readings belong to one spell while each follows the previous by at most one
    interval. Two passes keep every window partition bounded: islands are
    first found per meter-day (at most one day of readings), then the day
    fragments (far fewer rows) are stitched across midnight per meter.
    """
    gap = rules.interval_minutes * 60
    zero = (df.filter(F.col("avg_voltage") == 0)
              .select("meter_id", F.to_date("reading_ts").alias("_d"), "reading_ts"))
    frag = (_islands(zero, ["meter_id", "_d"], "reading_ts", "reading_ts", gap)
            .groupBy("meter_id", "_d", "_island")
            .agg(F.min("reading_ts").alias("first_ts"), F.max("reading_ts").alias("last_ts"),
                 F.count(F.lit(1)).alias("n")))
    spells = (_islands(frag, ["meter_id"], "first_ts", "last_ts", gap)
              .groupBy("meter_id", "_island")
              .agg(F.min("first_ts").alias("spell_start"), F.max("last_ts").alias("spell_end"),
                   F.sum("n").alias("readings")))
    return (spells.filter(F.col("readings") >= min_readings)
            .select("meter_id", "spell_start", "spell_end", "readings",
                    rnd(F.col("readings") * F.lit(float(rules.interval_minutes)) / F.lit(60.0), 2).alias("est_hours")))
