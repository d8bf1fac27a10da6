"""Outage spells as a stream: sessions of zero-voltage readings of a meter."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numeric import rnd
from ..functions.wallclock import to_instant, to_wallclock
from ..rules import KEY, MEASURES, RULES, Rules
from ..session import shared_dir
from .staged import stage_landed, staged_readings


def spell_sessions(readings: DataFrame, rules: Rules = RULES, watermark: str = "10 minutes", min_readings: int = 1) -> DataFrame:
    """Typed, valid readings (a stream or a batch) → spells as ``operators.spells.outage_spells`` gives them.

    Two stateful steps. The copies of a meter and time meet in a group that closes when the watermark passes
    the time; the copy that the curated table keeps (the lowest by the measures) goes on. Zero-voltage
    readings then form sessions: one goes on while the next reading follows by at most one interval, counted in
    whole seconds, and is emitted when the watermark passes the end of that gap. State holds the readings of the
    last minutes and the open spells.
    """
    ev = readings.withColumn("_et", to_instant(F.col("reading_ts"))).withWatermark("_et", watermark)
    kept = ev.groupBy("meter_id", "_et").agg(F.min(F.struct(*MEASURES)).alias("_keep"))
    zero = kept.filter(F.col("_keep.avg_voltage") == 0).select("meter_id", "_et")
    # a session takes a reading at the very end of its gap: that end lies just before one whole second past the interval
    gap = f"{rules.interval_minutes * 60} seconds 999999 microseconds"
    spells = (zero.groupBy("meter_id", F.session_window("_et", gap).alias("w"))
              .agg(F.min("_et").alias("a"), F.max("_et").alias("z"), F.count(F.lit(1)).alias("readings")))
    return (spells.filter(F.col("readings") >= min_readings)
            .select("meter_id", to_wallclock(F.col("a")).alias("spell_start"), to_wallclock(F.col("z")).alias("spell_end"), "readings",
                    rnd(F.col("readings") * F.lit(float(rules.interval_minutes)) / F.lit(60.0), 2).alias("est_hours")))


def spell_readings(readings: DataFrame, before, newest, delay: str) -> DataFrame:
    """The readings of a micro-batch that spells can depend on: every copy of a meter and time with a zero-voltage copy in
    the batch, and all readings that may have copies in other batches: those not after ``before``, the newest time of all
    earlier batches, and those after the watermark that the next batch will meet (``newest`` less ``delay``). The state then
    grows with the outages, not with the readings, and the newest reading still moves the watermark."""
    ts = F.col("reading_ts")
    open_ = ts > F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
    if before is not None:
        open_ = open_ | (ts <= F.lit(before).cast("timestamp_ntz"))
    zero = readings.filter(F.col("avg_voltage") == 0).select(*KEY).hint("shuffle_hash")
    return readings.filter(open_).unionByName(readings.filter(~open_).join(zero, list(KEY), "left_semi").select(*readings.columns))


def outage_spells_stream(spark: SparkSession, landing: str, sink_path: str, checkpoint: str | None = None, rules: Rules = RULES,
                         watermark: str = "10 minutes", min_readings: int = 1, max_files_per_trigger: int | None = None,
                         exclude: str | None = "Aggregated") -> dict:
    """Spells that have closed, of the files landed since the last run (``availableNow``), into a Parquet sink (append).
    An open spell waits in the state for the next run. Rejected and late rows are kept as dead letters (``staged``);
    readings that no spell can depend on (``spell_readings``) do not go to the stream."""
    checkpoint = checkpoint or shared_dir(spark, "spells-checkpoint")
    root = f"{checkpoint.rstrip('/')}/staged"
    done = stage_landed(spark, landing, root, watermark, rules, max_files_per_trigger, exclude,
                        keep=lambda readings, before, newest: spell_readings(readings, before, newest, watermark))
    q = (spell_sessions(staged_readings(spark, root, kept=True).drop("_et"), rules, watermark, min_readings)
         .writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/sessions").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return {"batches": done["batches"], "rows": done["rows"], "checkpoint": checkpoint, "staged": root}
