"""Landed files → typed readings on the way to stateful streams, with every other row kept as a dead letter.

Stage one reads landed lines micro-batch by micro-batch, each file by its own header, and writes
``rows/batch=<n>`` in two kinds: ``readings`` (typed, valid, in time) and ``dead`` (the line as landed, its file and why
it stopped: ``null``, ``out_of_range`` or ``late``). A row is late when its time is not after the watermark, the
largest time of all earlier micro-batches less the delay. Stateful streams then read ``readings`` in the order of the
batches; their own watermark is never ahead of stage one's, so they drop nothing that it has passed:

    rows landed = readings + dead letters.

Failure safety: a batch's folders have fixed names and are replaced when the batch runs again; the watermark a
batch was judged by is kept with it, so a replay judges alike. A stateful stream starts when stage one has
committed all batches of the run.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.wallclock import to_instant
from ..operators.clean import in_range, not_null, typed_readings
from ..rules import BASE_COLUMNS, RULES, Rules
from ..session import path_exists, session_conf
from ..sources.raw import normalize_columns, parse_lines
from .source import raw_line_stream

READINGS_SCHEMA = ("reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double, "
                   "meter_id string")
DEAD_SCHEMA = "line string, file string, reason string"
MARKS_SCHEMA = "batch_id bigint, watermark timestamp_ntz, newest timestamp_ntz, rows bigint"
#: what a stateful stream keeps of a batch's readings: these, the newest time of all earlier batches (or None), and
#: the newest time of all so far → its rows
Keep = Callable[[DataFrame, object, object], DataFrame]


def _marks(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/marks"):
        return spark.createDataFrame([], MARKS_SCHEMA)
    return spark.read.schema(MARKS_SCHEMA).parquet(f"{root}/marks")


def stage_batch(spark: SparkSession, lines: DataFrame, batch_id: int, root: str, delay: str, rules: Rules = RULES,
                keep: Keep | None = None) -> dict:
    """One micro-batch of landed lines (``value, file``); returns its number of ``rows`` and the ``watermark`` it met.
    What ``keep`` gives of its readings is written to ``kept/batch=<n>``."""
    earlier = _marks(spark, root).filter(F.col("batch_id") < batch_id).agg(F.max("newest").alias("newest"))
    watermark, before = earlier.select((F.col("newest") - F.expr(f"INTERVAL {delay}")).alias("w"), "newest").first()
    parsed = parse_lines(lines, keep=True)
    rows = typed_readings(normalize_columns(parsed, passthrough=("_line", "_source")), rules)
    late = F.lit(False) if watermark is None else F.col("reading_ts") <= F.lit(watermark).cast("timestamp_ntz")
    reason = F.when(~not_null(), "null").when(~in_range(rules), "out_of_range").when(late, "late")
    seen = Observation("staged_rows")
    judged = (rows.withColumn("reason", reason)
              # rejected and late rows do not move the watermark
              .observe(seen, F.count(F.lit(1)).alias("rows"), F.max(F.when(F.col("reason").isNull(), F.col("reading_ts"))).alias("newest"))
              # of a reading nobody asks for its line
              .select(*BASE_COLUMNS, *(F.when(F.col("reason").isNotNull(), F.col(c)).alias(n) for c, n in (("_line", "line"), ("_source", "file"))),
                      "reason", F.when(F.col("reason").isNull(), "readings").otherwise("dead").alias("kind")))
    # a task writes both kinds side by side; with one writer it would sort all its rows by kind
    with session_conf(judged.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        judged.write.mode("overwrite").partitionBy("kind").parquet(f"{root}/rows/batch={batch_id}")
    newest = seen.get["newest"]
    if keep and newest is not None:
        readings = spark.read.schema(READINGS_SCHEMA).parquet(f"{root}/rows/batch={batch_id}/kind=readings")
        keep(readings, before, max(newest, before or newest)).write.mode("overwrite").parquet(f"{root}/kept/batch={batch_id}")
    spark.createDataFrame([(batch_id, watermark, newest, seen.get["rows"])], MARKS_SCHEMA).coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/marks/of={batch_id}")
    return {"rows": seen.get["rows"], "watermark": watermark}


def stage_landed(spark: SparkSession, landing: str, root: str, delay: str = "10 minutes", rules: Rules = RULES,
                 max_files_per_trigger: int | None = None, exclude: str | None = "Aggregated", keep: Keep | None = None) -> dict:
    """Stage one for every file landed since the last run (``availableNow``); returns ``batches`` and ``rows`` of this run."""
    total = {"batches": 0, "rows": 0}

    def stage(lines: DataFrame, batch_id: int) -> None:
        done = stage_batch(spark, lines, batch_id, root, delay, rules, keep)
        total["batches"] += bool(done["rows"])
        total["rows"] += done["rows"]

    q = (raw_line_stream(spark, landing, exclude, max_files_per_trigger).writeStream
         .foreachBatch(stage).option("checkpointLocation", f"{root}/stage-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return total


def staged_readings(spark: SparkSession, root: str, kept: bool = False) -> DataFrame:
    """The staged readings (``kept``: what ``keep`` gave of them) as a stream with an event time ``_et``, in the order they
    were staged."""
    folders = f"{root}/kept/batch=*" if kept else f"{root}/rows/batch=*/kind=readings"
    df = spark.readStream.schema(READINGS_SCHEMA).option("recursiveFileLookup", "true").parquet(folders)
    return df.withColumn("_et", to_instant(F.col("reading_ts")))


def _kind(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    folders = f"{root}/rows/batch=*/kind={kind}"
    if not path_exists(spark, folders):  # no row of that kind so far
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folders)


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """``line, file, reason`` of every landed row that did not become a reading."""
    return _kind(spark, root, "dead", DEAD_SCHEMA)


def accounting(spark: SparkSession, root: str) -> dict:
    """Rows landed, staged and dead by reason, over all runs."""
    landed = _marks(spark, root).agg(F.sum("rows").alias("n")).first()["n"] or 0
    dead = {r["reason"]: r["n"] for r in dead_letters(spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    staged = _kind(spark, root, "readings", READINGS_SCHEMA).count()
    return {"landed": landed, "staged": staged, **{r: dead.get(r, 0) for r in ("null", "out_of_range", "late")}}
