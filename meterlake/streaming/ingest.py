"""Incremental ingest: newly landed CSV files → merged into the curated table.

Each micro-batch is parsed by the headers of its files, curated on its own and
classified in one join against the stored rows of the months and the time range
it touches. New keys are appended; a month is rewritten (dynamic partition
overwrite) only when the batch brings a copy of a stored key that wins the
de-duplication, so the usual batch of new readings writes new files and
rewrites nothing.

Failure safety: the classified batch, and a rewrite, are first written to a
staging folder whose path is fixed by the batch id (under the stream's
checkpoint), followed by a marker listing the months; only then is the table
overwritten from the staged copy. A batch replayed after a crash finds the
marker and re-applies the staged result instead of merging again, so a month
whose overwrite was cut short is never merged from incomplete stored rows; its
append skips keys that the table already holds. The staging of a batch is
removed when the next one begins, or the run ends, which is after its commit.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.clean import curate
from ..rules import CURATED_COLUMNS, KEY, MEASURES, RULES, Rules
from ..session import delete_path, observed_rows, path_exists, shared_dir
from ..sources.curated import write_curated
from ..sources.raw import normalize_columns, parse_lines
from .source import raw_line_stream

#: beaten copies that are sent to every task; more of them are shuffled
FEW = 500_000


def _existing(spark: SparkSession, path: str, absent: tuple[str, ...] = ("PATH_NOT_FOUND",)) -> DataFrame | None:
    """The Parquet data at ``path``; None when it fails for one of the ``absent`` reasons, any other failure is raised."""
    if "PATH_NOT_FOUND" in absent and not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in absent:
            raise
        return None


def _rewrite_months(spark: SparkSession, done: str) -> list[int] | None:
    """Months listed by a batch's completion marker; None when the marker is absent, or was cut short before its
    file was committed."""
    marker = _existing(spark, done, ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))
    return None if marker is None else list(marker.first()["months"])


def _ym() -> F.Column:
    return F.col("year") * 100 + F.col("month")


def _beats(new: str, old: str) -> F.Column:
    """The new copy of a key wins the de-duplication (lower by the measure order) over the stored one."""
    return (F.struct(*[F.col(f"{new}.{c}") for c in MEASURES])
            < F.struct(*[F.col(f"{old}.{c}") for c in MEASURES]))


def merge_batch(spark: SparkSession, batch: DataFrame, table_path: str, staging_root: str,
                rules: Rules = RULES, batch_id: int = 0) -> dict:
    """Merge one batch of raw rows (curated names) into the table; returns ``rows`` (raw), ``months`` (touched) and
    ``rewritten`` (months).

    Each curated batch row is matched by key against the stored rows of the
    months and time range it touches (key and measure columns only):
    - a new key is appended (no existing file is touched);
    - a key whose stored copy wins is dropped;
    - a key the batch wins forces its month to be rewritten: the month's stored
      rows without the beaten copies, and its new and winning batch rows, are
      staged and written back with dynamic partition overwrite.
    Replays are safe: the rewrite is re-applied from its staged copy (marker
    file), and appends skip keys the table already holds.
    """
    stage, done = f"{staging_root}/batch-{batch_id}", f"{staging_root}/batch-{batch_id}.done"
    rewrite = _rewrite_months(spark, done)
    replayed = rewrite is not None
    old = _existing(spark, table_path)
    seen = Observation("raw_rows")
    new = curate(batch.observe(seen, F.count(F.lit(1)).alias("rows")), rules)
    new.write.mode("overwrite").parquet(f"{stage}/new")
    new = spark.read.parquet(f"{stage}/new")
    span = new.agg(F.collect_set(_ym()).alias("months"), F.min("reading_ts").alias("a"), F.max("reading_ts").alias("z")).first()
    touched = sorted(span.months)  # bounded by the calendar
    if not touched:
        return {"rows": observed_rows(seen, batch), "months": [], "rewritten": []}
    if old is None:
        met = new.withColumn("_wins", F.lit(None).cast("boolean"))
    else:
        stored = (old.filter(_ym().isin(touched) & F.col("reading_ts").between(span.a, span.z))
                  .select(*KEY, *MEASURES, F.lit(True).alias("_old")))
        met = (new.alias("n").join(stored.alias("o"), list(KEY), "left")
               .select(*[F.col(f"n.{c}") for c in CURATED_COLUMNS], F.when(F.col("o._old"), _beats("n", "o")).alias("_wins")))
    met.write.mode("overwrite").parquet(f"{stage}/met")
    met = spark.read.parquet(f"{stage}/met")
    if not replayed:
        won = {r["ym"]: r["n"] for r in met.filter("_wins").groupBy(_ym().alias("ym")).agg(F.count(F.lit(1)).alias("n")).collect()}
        rewrite = sorted(won)
        if rewrite:
            scope = _ym().isin(rewrite)
            beaten = met.filter("_wins").select(*KEY)
            beaten = F.broadcast(beaten) if sum(won.values()) <= FEW else beaten
            merged = (old.filter(scope).select(*CURATED_COLUMNS).join(beaten, list(KEY), "left_anti").select(*CURATED_COLUMNS)
                      .unionByName(met.filter(scope & F.coalesce("_wins", F.lit(True))).drop("_wins")))
            merged.write.mode("overwrite").parquet(f"{stage}/merged")
        spark.createDataFrame([(batch_id, rewrite)], "batch_id long, months array<int>") \
            .write.mode("overwrite").parquet(done)
    if rewrite:
        write_curated(spark.read.parquet(f"{stage}/merged"), table_path, mode="overwrite", dynamic=True)
    add = met.filter(F.col("_wins").isNull() & ~_ym().isin(rewrite)) if rewrite else met.filter("_wins IS NULL")
    write_curated(add, table_path, mode="append")
    return {"rows": observed_rows(seen, batch), "months": touched, "rewritten": rewrite}


def incremental_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str | None = None,
                       rules: Rules = RULES, max_files_per_trigger: int | None = None,
                       exclude: str | None = "Aggregated") -> dict:
    """Process every file landed since the last run (``availableNow``), then stop.

    The checkpoint remembers which files were ingested (the job-bookmark role);
    a second call picks up only new files. Returns the number of ``batches`` and
    raw ``rows``, the ``months`` touched (``year * 100 + month``, what the
    rollups must refresh) and the ``checkpoint``.
    """
    checkpoint = checkpoint or shared_dir(spark, "ingest-checkpoint")
    staging_root = f"{checkpoint.rstrip('/')}/staging"
    total = {"batches": 0, "rows": 0, "months": set()}
    last: list[int] = []

    def merge(lines: DataFrame, batch_id: int) -> None:
        _drop_staging(spark, staging_root, last)
        result = merge_batch(spark, normalize_columns(parse_lines(lines)), table_path, staging_root, rules, batch_id)
        last.append(batch_id)
        if result["rows"]:
            total["batches"] += 1
            total["rows"] += result["rows"]
            total["months"].update(result["months"])

    q = (raw_line_stream(spark, landing, exclude, max_files_per_trigger).writeStream
         .foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    _drop_staging(spark, staging_root, last)
    return {**total, "months": sorted(total["months"]), "checkpoint": checkpoint}


def _drop_staging(spark: SparkSession, staging_root: str, batches: list[int]) -> None:
    """Remove the staging of committed batches."""
    while batches:
        batch = batches.pop()
        delete_path(spark, f"{staging_root}/batch-{batch}")
        delete_path(spark, f"{staging_root}/batch-{batch}.done")
