"""Health alerts: per meter and 15-minute window, counts of unhealthy readings (watermarked)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import drop_nulls, enrich, range_filter, typed_readings
from ..rules import BASE_COLUMNS, RULES, Rules
from ..session import shared_dir
from ..functions.wallclock import to_instant, to_wallclock
from .staged import stage_landed, staged_readings


def alert_windows(readings: DataFrame, rules: Rules = RULES, window: str = "15 minutes",
                  watermark: str = "10 minutes", min_unhealthy: int = 1) -> DataFrame:
    """Streaming (or batch) readings → alert rows per (meter, window).

    Stateless cleaning and enrichment, then exact copies dropped within the
    watermark and a tumbling-window count per status. Rows later than the
    watermark are dropped; a window is emitted once the watermark passes its end.
    Only exact copies are dropped, as a stream can not take back a reading: two
    different readings of one meter and time both count here, while the curated
    table keeps one of them.
    """
    valid = range_filter(drop_nulls(typed_readings(readings, rules)), rules)
    ev = enrich(valid.select(*BASE_COLUMNS), rules).withColumn("_et", to_instant(F.col("reading_ts")))
    s = F.col("health_status")
    ev = ev.withWatermark("_et", watermark)
    # exact copies: bounded state in a stream, a plain distinct on a batch
    ev = (ev.dropDuplicatesWithinWatermark(list(BASE_COLUMNS)) if ev.isStreaming
          else ev.dropDuplicates(list(BASE_COLUMNS)))
    agg = (ev.groupBy(F.window("_et", window).alias("w"), "meter_id")
             .agg(F.count(F.lit(1)).alias("readings"),
                  F.count_if(s != "HEALTHY").alias("unhealthy"),
                  F.count_if(s == "CRITICAL").alias("critical"),
                  F.count_if(s == "WARNING").alias("warning"),
                  F.count_if(s == "HIGH_LOAD").alias("high_load"),
                  F.count_if(s == "POSSIBLE_METER_ISSUE").alias("meter_issue"),
                  F.min("health_score").alias("min_score")))
    return (agg.filter(F.col("unhealthy") >= min_unhealthy)
               .select("meter_id", to_wallclock(F.col("w.start")).alias("window_start"),
                       to_wallclock(F.col("w.end")).alias("window_end"), "readings", "unhealthy",
                       "critical", "warning", "high_load", "meter_issue", "min_score"))


def health_alerts_stream(spark: SparkSession, landing: str, sink_path: str, checkpoint: str | None = None,
                         rules: Rules = RULES, window: str = "15 minutes", watermark: str = "10 minutes",
                         min_unhealthy: int = 1, max_files_per_trigger: int | None = None,
                         exclude: str | None = "Aggregated") -> dict:
    """Run the alert stream over the files landed since the last run (``availableNow``) into a Parquet sink (append).

    Landed files are first staged by their own headers (``staged``): rejected and late rows are kept as
    ``dead_letters(spark, out["staged"])``, and ``accounting`` adds them up.
    """
    checkpoint = checkpoint or shared_dir(spark, "alerts-checkpoint")
    root = f"{checkpoint.rstrip('/')}/staged"
    done = stage_landed(spark, landing, root, watermark, rules, max_files_per_trigger, exclude)
    alerts = alert_windows(staged_readings(spark, root).drop("_et"), rules, window, watermark, min_unhealthy)
    q = (alerts.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/windows").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return {"batches": done["batches"], "rows": done["rows"], "checkpoint": checkpoint, "staged": root}
