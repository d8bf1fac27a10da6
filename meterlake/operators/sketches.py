"""Mergeable summaries: distinct meters and quantiles of any period without another look at the readings.

- Distinct meters: one HyperLogLog sketch of the meters for each hour and status. Sketches of any hours unite to the
  sketch of the period; the estimate's relative standard error is about ``1.04 / sqrt(2 ** lg_k)`` (1.6 % at 12), and
  small sets are counted exactly.
- Quantiles: counts of values in fixed buckets, for each day and column. A value is a whole number of
  ``10**-decimals`` units; its bucket is itself below ``2**bits`` units, and beyond that its leading ``bits`` binary
  digits, so a bucket is at most ``2**(1 - bits)`` of its lower end wide. Counts of any days add up. The discrete
  quantile lies in the reported bucket, whose middle is off by half that width at most (0.4 % at 8 bits). Buckets do
  not depend on the data, so results do not depend on the order of merging, and withdrawn rows can be taken off.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import readings as R
from ..functions.numeric import rnd

LG_K = 12
BITS = 8
#: measured decimals of the curated columns that are summarised
DECIMALS = {"energy_kwh": 6, "avg_voltage": 3, "avg_current": 3, "frequency_hz": 6, "power_kw": 4, "health_score": 2}


# --- distinct meters ------------------------------------------------------------------------------------

def status_sketches(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``hour_ts, health_status, readings, meters`` (a sketch) of curated rows."""
    return (df.groupBy(R.hour_ts().alias("hour_ts"), "health_status")
            .agg(F.count(F.lit(1)).alias("readings"), F.hll_sketch_agg("meter_id", lg_k).alias("meters")))


def of_period(cells: DataFrame, since=None, until=None, time: str = "hour_ts") -> DataFrame:
    """Cells from ``since`` to before ``until``."""
    if since is not None:
        cells = cells.filter(F.col(time) >= F.lit(since).cast("timestamp_ntz"))
    return cells if until is None else cells.filter(F.col(time) < F.lit(until).cast("timestamp_ntz"))


def meters_by_status(sketches: DataFrame, *by: Column) -> DataFrame:
    """``…, health_status, readings, meters``: distinct meters seen in each status, for each value of ``by`` (expressions of
    ``hour_ts``; none: over all)."""
    return (sketches.groupBy(*by, "health_status")
            .agg(F.sum("readings").alias("readings"), F.hll_sketch_estimate(F.hll_union_agg("meters")).alias("meters")))


def kpi_meters(sketches: DataFrame) -> DataFrame:
    """One row of meters in all and ever seen in a status, as ``q24_kpis`` counts them."""
    def seen(status: str | None) -> Column:
        own = F.col("meters") if status is None else F.when(F.col("health_status") == status, F.col("meters"))
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(own)), F.lit(0)).cast("bigint")
    return sketches.agg(seen(None).alias("total_meters"), *(seen(s).alias(f"meters_seen_{s.lower()}") for s in ("HEALTHY", "WARNING", "CRITICAL")))


# --- quantiles ------------------------------------------------------------------------------------------

def bucket(units: Column, bits: int = BITS) -> Column:
    """Lower end of the bucket of a non-negative BIGINT: the value with all but its leading ``bits`` binary digits cleared."""
    drop = F.greatest(F.length(F.bin(units)) - F.lit(bits), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", units, drop), drop)


def bucket_middle(low: Column, bits: int = BITS) -> Column:
    """The middle of the whole numbers in the bucket with this lower end."""
    drop = F.greatest(F.length(F.bin(low)) - F.lit(bits), F.lit(0))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), drop)
    return low + (width - F.lit(1)) / F.lit(2.0)


def value_histograms(df: DataFrame, decimals: dict[str, int] | None = None, bits: int = BITS) -> DataFrame:
    """``reading_date, column, low, n`` of curated rows: how many values of each day and column fall in each bucket. Null
    values are not counted; values are non-negative (the curated ranges see to it)."""
    decimals = DECIMALS if decimals is None else decimals
    units = [F.struct(F.lit(c).alias("column"), F.floor(F.col(c) * F.lit(10.0 ** d) + F.lit(0.5)).cast("bigint").alias("units"))
             for c, d in decimals.items()]
    stacked = df.select(R.reading_date("reading_ts").alias("reading_date"), F.explode(F.array(*units)).alias("s")).filter("s.units IS NOT NULL")
    return (stacked.groupBy("reading_date", F.col("s.column").alias("column"), bucket(F.col("s.units"), bits).alias("low"))
            .agg(F.count(F.lit(1)).alias("n")))


def merged_histograms(cells: DataFrame, *by: Column | str) -> DataFrame:
    """Counts of the buckets over all days of each value of ``by`` and column."""
    return cells.groupBy(*by, "column", "low").agg(F.sum("n").alias("n"))


def histogram_quantiles(counts: DataFrame, probs=(0.25, 0.5, 0.75), by: tuple[str, ...] = (), decimals: dict[str, int] | None = None,
                        bits: int = BITS) -> DataFrame:
    """``…by, column, count`` and one ``p…`` column for each of ``probs``: the middle of the bucket that holds the discrete quantile
    (rank ``ceil(p * count)``). A group has at most some 2**(bits - 1) buckets for each binary digit of its largest value."""
    decimals = DECIMALS if decimals is None else decimals
    keys = [*by, "column"]
    group = Window.partitionBy(*keys)
    run = group.orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_upto", F.sum("n").over(run)).withColumn("_all", F.sum("n").over(group))
    scale = F.lit(None).cast("double")
    for c, d in decimals.items():
        scale = F.when(F.col("column") == c, F.lit(10.0 ** d)).otherwise(scale)
    out = []
    for p in probs:
        name = f"p{100 * p:g}".replace(".", "_")
        reached = F.col("_upto") >= F.ceil(F.col("_all") * F.lit(p))
        out.append(rnd(bucket_middle(F.min(F.when(reached, F.col("low"))), bits) / F.first(scale), 6).alias(name))
    return placed.groupBy(*keys).agg(F.max("_all").alias("count"), *out)


def rank_error(df: DataFrame, column: str, value: float, p: float) -> float:
    """How far, as a share of all values, ``value`` lies from the discrete ``p`` quantile's rank."""
    c = df.agg(F.count(column).alias("n"), F.count_if(F.col(column) < value).alias("below"), F.count_if(F.col(column) <= value).alias("upto")).first()
    rank = max(1, math.ceil(p * c["n"]))
    return max(c["below"] + 1 - rank, rank - c["upto"], 0) / c["n"]
