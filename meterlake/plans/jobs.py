"""Batch jobs: raw CSV → curated table, curated table → hourly rollup."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.clean import clean, enrich
from ..operators.grains import daily_rollup, hourly_rollup
from ..operators.quality import rejects
from ..rules import RULES, Rules
from ..session import observed_rows
from ..sources.curated import layout, write_curated, write_table
from ..sources.raw import normalize_columns, read_raw_csv


def curation_job(spark: SparkSession, raw_paths, output_path: str, rules: Rules = RULES,
                 order: str = "filter_first", mode: str = "overwrite", dynamic: bool = False,
                 metrics: dict | None = None, rejects_path: str | None = None) -> int:
    """Read raw CSVs, curate, write the partitioned table; returns rows written.

    Rows in and rows out are ``Observation`` metrics collected while the write
    runs (no second pass over the input); pass a dict as ``metrics`` to get
    ``rows_in``, ``rows_out`` and ``rejected`` (nulls, out of range and
    duplicate copies together). With ``rejects_path``, the rejected rows are
    written there as given, with reason and number of copies (a second scan).
    """
    seen, kept = Observation("raw_rows"), Observation("curated_rows")
    given = normalize_columns(read_raw_csv(spark, raw_paths))
    if rejects_path:
        write_table(rejects(given, rules), rejects_path)
    raw = given.observe(seen, F.count(F.lit(1)).alias("rows"))
    curated = curate_laid_out(raw, rules, order).observe(kept, F.count(F.lit(1)).alias("rows"))
    write_curated(curated, output_path, mode=mode, dynamic=dynamic, laid_out=True)
    rows_in, rows_out = observed_rows(seen, given), observed_rows(kept, curated)
    if metrics is not None:
        metrics.update(rows_in=rows_in, rows_out=rows_out, rejected=rows_in - rows_out)
    return rows_out


def curate_laid_out(raw: DataFrame, rules: Rules = RULES, order: str = "filter_first") -> DataFrame:
    """``curate`` with the write layout applied to the six base columns only.

    The derived columns (bands, score, status, calendar) are pure functions of
    the base row, so they are computed after the rebalance shuffle and the
    sort: the shuffle and the sort carry 8 narrow columns instead of 18, and a
    projection keeps the sort order the partitioned writer needs.
    """
    base = clean(raw, rules, order)
    base = base.select(*base.columns, F.year("reading_ts").alias("year"), F.month("reading_ts").alias("month"))
    return enrich(layout(base), rules)


def _of_months(spark: SparkSession, table: DataFrame | str, months: Iterable[int] | None) -> DataFrame:
    df = spark.read.parquet(table) if isinstance(table, str) else table
    return df if months is None else df.filter((F.col("year") * 100 + F.col("month")).isin(list(months)))


def rollup_job(spark: SparkSession, curated: DataFrame | str, output_path: str,
               months: Iterable[int] | None = None) -> None:
    """Hourly rollup persisted as Parquet partitioned like the curated table; with ``months``
    (``year * 100 + month``) only those are rebuilt, and the files of others stay."""
    write_table(hourly_rollup(_of_months(spark, curated, months), laid_out=True), output_path, partition_by=("year", "month"),
                dynamic=months is not None, laid_out=True)


def daily_rollup_job(spark: SparkSession, table: DataFrame | str, output_path: str,
                     months: Iterable[int] | None = None) -> None:
    """Daily rollup of the curated table or of the hourly rollup, persisted like the hourly one."""
    write_table(daily_rollup(_of_months(spark, table, months), laid_out=True), output_path, partition_by=("year", "month"),
                dynamic=months is not None, laid_out=True)


def refresh_rollups(spark: SparkSession, curated: str, hourly_path: str, daily_path: str, months: Iterable[int]) -> None:
    """Rebuild both rollups for the months that an ingest has touched (``incremental_ingest`` reports them); the daily
    one from the hourly one."""
    months = sorted(months)
    if months:
        rollup_job(spark, curated, hourly_path, months)
        daily_rollup_job(spark, hourly_path, daily_path, months)
