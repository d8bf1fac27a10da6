"""Incremental ingest into a versioned table: each micro-batch becomes one atomic version.

A batch is parsed by the headers of its files, curated and written once, as files of a commit that nobody
sees yet. Live files whose months, times and meters the batch meets are matched by key (key and measure
columns only). Of two copies of a key one loses: rewritten are just the files that hold a losing copy,
without it, be they stored or of this batch. Then the new list of live files is committed.

Failure safety: until the commit the table is as it was, whatever step was cut short. The version names the
stream's batch, so a batch that is replayed after its commit does nothing. A commit of another writer in
between (a compaction, say) makes the batch match again against that version; its own files stay.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.clean import curate
from ..rules import CURATED_COLUMNS, KEY, MEASURES, RULES, Rules
from ..session import delete_path, observed_rows, shared_dir
from ..sources.raw import normalize_columns, parse_lines
from ..sources.versions import (FILE, CommitConflict, commit, live_files, read_files, version, write_files)
from .source import raw_line_stream

ATTEMPTS = 10
#: losing copies (key and file) that are sent to every task; more of them are shuffled
FEW = 500_000


def _beats(new: str, old: str) -> F.Column:
    return F.struct(*[F.col(f"{new}.{c}") for c in MEASURES]) < F.struct(*[F.col(f"{old}.{c}") for c in MEASURES])


def _met(files: DataFrame, added: DataFrame) -> list[str]:
    """Live files that can hold a key of the added ones: of the same month, with ranges that overlap."""
    own = added.groupBy("year", "month").agg(
        *(F.min(c).alias(f"_{c}") for c in ("first_ts", "first_meter")), *(F.max(c).alias(f"_{c}") for c in ("last_ts", "last_meter")))
    near = files.join(own, ["year", "month"]).filter(
        (F.col("first_ts") <= F.col("_last_ts")) & (F.col("last_ts") >= F.col("_first_ts"))
        & (F.col("first_meter") <= F.col("_last_meter")) & (F.col("last_meter") >= F.col("_first_meter")))
    return [r["file"] for r in near.select("file").collect()]


def merge_version(spark: SparkSession, batch: DataFrame, root: str, rules: Rules = RULES, stream: str = "", batch_id: int | None = None) -> dict:
    """Merge raw rows (curated names) into the table as one version; returns ``rows`` (raw), ``files`` (that the batch
    added), ``rewritten`` (files that lost a copy) and ``version``. With ``batch_id``, a batch of ``stream`` that the
    table already holds is left out (``rows`` 0)."""
    base = version(spark, root)
    staged = None
    if batch_id is not None and base and base.batches.get(stream, -1) >= batch_id:
        return {"rows": 0, "files": 0, "rewritten": 0, "version": base.number}
    seen = Observation("raw_rows")
    added = write_files(spark, curate(batch.observe(seen, F.count(F.lit(1)).alias("rows")), rules), root)
    fresh = [r["file"] for r in added.select("file").collect()]
    for attempt in range(ATTEMPTS):
        live, lost, replaced, changes = live_files(spark, root, base), [], None, None
        if staged:
            delete_path(spark, staged)
            staged = None
        if fresh and (met := _met(live, added)):
            columns = (*KEY, *MEASURES)
            # through the join goes a file's number, not its long name
            number = F.broadcast(spark.createDataFrame(list(enumerate([*fresh, *met])), f"_no int, {FILE} string"))

            def numbered(files: list[str]) -> DataFrame:
                return read_files(spark, root, files, columns).join(number, FILE).drop(FILE)

            both = numbered(fresh).alias("n").join(numbered(met).alias("o"), list(KEY))
            losers = both.select(*KEY, F.when(_beats("n", "o"), F.col("o._no")).otherwise(F.col("n._no")).alias("_no")).join(number, "_no").drop("_no")
            staged = shared_dir(spark, "losing-copies")
            losers.write.parquet(staged)
            losers = spark.read.schema(losers.schema).parquet(staged)
            count = {r[FILE]: r["n"] for r in losers.groupBy(FILE).agg(F.count(F.lit(1)).alias("n")).collect()}
            lost = [*count]
            if sum(count.values()) <= FEW:
                losers = F.broadcast(losers)
            if lost:
                kept = read_files(spark, root, lost).join(losers, [*KEY, FILE], "left_anti")
                replaced = write_files(spark, kept.drop(FILE), root)
            if base is not None:
                came = read_files(spark, root, fresh).join(losers, [*KEY, FILE], "left_anti")
                gone = read_files(spark, root, [f for f in lost if f not in set(fresh)]).join(losers, [*KEY, FILE], "left_semi")
                changes = came.select(*CURATED_COLUMNS, F.lit(1).cast("bigint").alias("_sign")).unionByName(
                    gone.select(*CURATED_COLUMNS, F.lit(-1).cast("bigint").alias("_sign")))
        gone = spark.createDataFrame([(f,) for f in lost], "file string")
        files = live.unionByName(added).join(gone, "file", "left_anti") if lost else live.unionByName(added)
        files = files.unionByName(replaced) if replaced is not None else files
        try:
            done = commit(spark, root, base, files, {} if batch_id is None else {stream: batch_id}, changes)
            if staged:
                delete_path(spark, staged)
            return {"rows": observed_rows(seen, batch), "files": len(fresh), "rewritten": len(lost), "version": done.number}
        except CommitConflict:
            if attempt + 1 == ATTEMPTS:
                raise
            base = version(spark, root)
    raise AssertionError("unreachable")


def versioned_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str | None = None, rules: Rules = RULES,
                     max_files_per_trigger: int | None = None, exclude: str | None = "Aggregated") -> dict:
    """Process every file landed since the last run (``availableNow``), one version for each micro-batch, then stop.
    Returns ``batches`` and raw ``rows`` of this run, the newest ``version`` and the ``checkpoint``, whose path names
    the stream inside the table."""
    checkpoint = checkpoint or shared_dir(spark, "ingest-checkpoint")
    total = {"batches": 0, "rows": 0, "version": None}

    def merge(lines: DataFrame, batch_id: int) -> None:
        done = merge_version(spark, normalize_columns(parse_lines(lines)), root, rules, checkpoint, batch_id)
        total["batches"] += bool(done["rows"])
        total["rows"] += done["rows"]

    q = (raw_line_stream(spark, landing, exclude, max_files_per_trigger).writeStream
         .foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    now = version(spark, root)
    return {**total, "version": now.number if now else None, "checkpoint": checkpoint}
