"""Stand-in meter readings derived from the driver's star-schema tables.

The test tables hold no meter data, so raw readings are computed from
``lineitem`` with integer arithmetic (FIXTURES.md F6): every branch of the
curation rules is hit (outages, over-voltage, dead meters, NULLs, duplicate
keys) and all measured values are dyadic, so sums are exact in double.
The work grows with ``lineitem``; nothing is sampled or capped.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .raw import RAW_HEADERS


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(x) -> Column:
    return F.lit(x).cast("double")


def _meter_id(number: Column) -> Column:
    """Town prefix and the number, padded to four digits; longer numbers keep all of theirs."""
    digits = number.cast("string")
    return F.concat(F.when(number % 2 == 0, F.lit("BR")).otherwise(F.lit("MH")),
                    F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


def standin_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw typed readings (reading_ts, energy_kwh, avg_voltage, avg_current, frequency_hz, meter_id)."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_shipdate")
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    li = li.withColumn("o", (ok * 7 + ln * 131 + pk) % 480)
    o = F.col("o")
    divisor = F.when(sk % 3 == 0, _d(8192)).when(sk % 3 == 1, _d(2048)).otherwise(_d(512))
    evening = F.when((sk % 5 == 0) & (o >= 360), _d(8)).otherwise(_d(1))
    spike = F.when((sk % 7 == 3) & (ok % 31 == 0), _d(64)).otherwise(_d(1))
    outage = (ok + ln) % 23 == 0
    reading_ts = F.timestamp_add("MINUTE", (o * 3).cast("int"), F.col("l_shipdate"))
    meter_id = _meter_id(sk)
    base = li.select(
        reading_ts.alias("reading_ts"),
        F.when((ok + ln) % 29 == 0, _d(0))
         .otherwise(F.col("l_quantity") / divisor * evening * spike).alias("energy_kwh"),
        F.when((ok + pk) % 997 == 0, _d(450)).when(outage, _d(0))
         .otherwise(_d(190) + ((pk * 37 + ok * 11 + ln) % 560).cast("double") * _d(0.125)).alias("avg_voltage"),
        F.when(ok % 499 == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.col("l_tax") * _d(100)).cast("int").cast("double") * _d(1.5)).alias("avg_current"),
        F.when(outage, _d(0))
         .otherwise(_d(49.25) + ((ok * 13 + ln) % 100).cast("double") / _d(64)).alias("frequency_hz"),
        meter_id.alias("meter_id"),
        ((ok * 3 + ln) % 211 == 0).alias("_dup"),
    )
    # a duplicate-key copy (same meter and time, fixed values) for some rows, generated from the same scan
    cols = ["reading_ts", "energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "meter_id"]
    row = F.struct(*[F.col(c) for c in cols])
    copy = F.struct(F.col("reading_ts"), _d(0.5).alias("energy_kwh"), _d(230).alias("avg_voltage"),
                    _d(1.5).alias("avg_current"), _d(50).alias("frequency_hz"), F.col("meter_id"))
    both = F.when(F.col("_dup"), F.array(row, copy)).otherwise(F.array(row))
    return base.select(F.explode(both).alias("_r")).select("_r.*")


def standin_raw_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in readings laid out as the raw CSV (original headers, text values)."""
    return as_raw_frame(standin_readings(spark, sf_dir))


def as_raw_frame(r: DataFrame) -> DataFrame:
    """Typed readings → raw CSV layout (original headers, text values)."""
    ts = F.col("reading_ts").cast("string")   # timestamp_ntz → 'yyyy-MM-dd HH:mm:ss' (grid times carry no fraction)
    vals = [ts, F.col("energy_kwh").cast("string"), F.col("avg_voltage").cast("string"),
            F.col("avg_current").cast("string"), F.col("frequency_hz").cast("string"), F.col("meter_id")]
    return r.select(*[v.alias(h) for v, h in zip(vals, RAW_HEADERS)])


def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings derived from the ``events`` stream table (one meter per user).

    Timestamps are snapped to the 3-minute grid; values are dyadic functions of
    ``event_id`` in the same style as ``standin_readings``.
    """
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    minute_of_day = F.hour("ts") * 60 + F.minute("ts")
    snapped = F.timestamp_add("MINUTE", (minute_of_day - minute_of_day % 3).cast("int"),
                              F.to_date("ts").cast("timestamp_ntz"))
    outage = eid % 41 == 0
    return ev.select(
        snapped.alias("reading_ts"),
        F.when(eid % 17 == 0, _d(0)).otherwise((eid % 64 + 1).cast("double") / _d(1024)).alias("energy_kwh"),
        F.when(eid % 97 == 0, _d(250)).when(outage, _d(0))
         .otherwise(_d(196) + (eid % 320).cast("double") * _d(0.125)).alias("avg_voltage"),
        ((eid % 13).cast("double") * _d(0.75)).alias("avg_current"),
        F.when(outage, _d(0)).otherwise(_d(49.25) + (eid % 100).cast("double") / _d(64)).alias("frequency_hz"),
        _meter_id(uid).alias("meter_id"),
    )
