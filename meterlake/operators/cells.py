"""Hourly cells kept up to date from the changes between two versions of the curated table.

A cell (meter and hour) has sums that can be added to and taken from (exact decimals), and extremes that
can only be added to. The rows of the files by which two versions differ are netted: a row that was merely
moved to another file cancels out, a new one counts +1, a withdrawn one -1. Cells gain the signed sums;
only where the withdrawn rows hold a cell's highest power or worst reading, and the new rows none as
extreme, is the cell computed anew, from the files that its hour and meter select.

Cells are stored as a log: ``v=<version>`` holds the new values of the cells that this version touched, and the
newest value of a cell counts. Reading folds the log by one aggregation; ``fold_cells`` writes it folded.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import readings as R
from ..rules import CURATED_COLUMNS, KEY, RULES, Rules
from ..session import delete_path, path_exists, shared_dir
from ..sources.versions import FILE, kept_changes, live_files, read_files, version
from .grains import scaled_units, status_from_key, worst_status_key

#: decimal places of the exact sums
PLACES = 15
SUMS = {"energy_kwh": "energy_kwh", "avg_voltage": "voltage_sum", "avg_current": "current_sum", "health_score": "score_sum"}
ADDITIVE = (*SUMS.values(), "power_units", "readings")
CELL = ("meter_id", "hour_ts")
_DECIMAL = f"decimal(38,{PLACES})"


def _signed(c: Column, sign: Column | None) -> Column:
    return F.sum(c if sign is None else c * sign)


def cell_sums(df: DataFrame, power_decimals: int, sign: str | None = None) -> list[Column]:
    """Aggregates for the additive columns; with ``sign`` (a column of whole numbers), signed."""
    s = F.col(sign) if sign else None
    few = None if s is None else s.cast("decimal(5,0)")   # a wider factor would cost the product decimal places
    exact = [_signed(F.col(c).cast(f"decimal(20,{PLACES})"), few).cast(_DECIMAL).alias(a) for c, a in SUMS.items()]
    return [*exact, _signed(scaled_units("power_kw", power_decimals), s).cast("bigint").alias("power_units"),
            (F.count(F.lit(1)) if s is None else F.sum(s)).cast("bigint").alias("readings")]


def cells_of(df: DataFrame, power_decimals: int = RULES.power_decimals) -> DataFrame:
    """Cells of curated rows: ``meter_id, hour_ts``, the additive columns, ``peak_power_kw`` and ``worst`` (a key that orders
    readings from the worst)."""
    return (df.groupBy("meter_id", R.hour_ts().alias("hour_ts"))
            .agg(*cell_sums(df, power_decimals), F.max("power_kw").alias("peak_power_kw"), F.min(worst_status_key()).alias("worst")))


def hourly_from_cells(cells: DataFrame, power_decimals: int = RULES.power_decimals) -> DataFrame:
    """The columns of ``grains.hourly_rollup`` from cells."""
    t = R.time_attributes("hour_ts")
    n = F.col("readings")

    def mean(total: str) -> Column:
        return F.col(total).cast("double") / n

    return cells.select(
        "meter_id", *(t[c].alias(c) for c in ("year", "month", "day", "hour", "day_of_week", "is_weekend")), "hour_ts",
        F.col("energy_kwh").cast("double").alias("energy_kwh"), mean("voltage_sum").alias("avg_voltage"), mean("current_sum").alias("avg_current"),
        (F.col("power_units").cast("double") / n / F.lit(10.0 ** power_decimals)).alias("avg_power_kw"), "peak_power_kw",
        mean("score_sum").alias("health_score"), status_from_key(F.col("worst")).alias("worst_health_status"), "readings")


# --- changes --------------------------------------------------------------------------------------------

def changed_rows(spark: SparkSession, root: str, since: int | None, until: int) -> DataFrame:
    """Curated rows with ``_sign``: how many copies version ``until`` holds more than ``since`` (None: an empty table). Reads the
    changes that the versions between kept, or else the files by which the two differ, no others; rows that are in both cancel
    out."""
    noted = None if since is None else kept_changes(spark, root, since, until)
    if noted is not None:
        return noted if until == since + 1 else _net(noted)
    old = live_files(spark, root, None if since is None else version(spark, root, since)).select("file")
    new = live_files(spark, root, version(spark, root, until)).select("file")

    def rows(files: DataFrame, sign: int) -> DataFrame:
        return read_files(spark, root, [r["file"] for r in files.collect()]).drop(FILE).withColumn("_sign", F.lit(sign).cast("bigint"))

    gone = old.join(new, "file", "left_anti")
    came = rows(new.join(old, "file", "left_anti"), 1)
    if gone.isEmpty():  # appended files only: nothing can cancel out
        return came
    return _net(came.unionByName(rows(gone, -1)))


def _net(rows: DataFrame) -> DataFrame:
    """Rows dealt by meter and time before they are counted: few come more than twice, and a map task would hold them all."""
    return rows.repartition(*KEY).groupBy(*CURATED_COLUMNS).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")


def cell_changes(rows: DataFrame, power_decimals: int = RULES.power_decimals) -> DataFrame:
    """Signed rows → for each touched cell the signed sums, and the extremes of the new (``new_…``) and the withdrawn rows
    (``old_…``)."""
    came, gone = F.col("_sign") > 0, F.col("_sign") < 0
    worst = F.struct(worst_status_key().alias("key"))
    # sparse data have a cell for nearly every row: dealt by cell and sorted (a struct is no hash table's value), not held by map tasks
    own = rows.select("meter_id", R.hour_ts().alias("hour_ts"), *SUMS, "power_kw", "health_status", "_sign").repartition(*CELL)
    cells = own.groupBy(*CELL).agg(
        *cell_sums(own, power_decimals, "_sign"),
        F.max(F.when(came, F.col("power_kw"))).alias("new_peak"), F.max(F.when(gone, F.col("power_kw"))).alias("old_peak"),
        F.min(F.when(came, worst)).alias("new_worst"), F.min(F.when(gone, worst)).alias("old_worst"))
    return cells.withColumns({c: F.col(f"{c}.key") for c in ("new_worst", "old_worst")})


def merged_cells(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """Touched cells with their new values, and ``stale``: an extreme was withdrawn and the cell must be computed anew. A cell
    that has lost its last reading stays with ``readings`` 0."""
    j = changes.alias("d").join(cells.alias("c"), list(CELL), "left")

    def total(c: str) -> Column:
        return F.coalesce(F.col(f"c.{c}"), F.lit(0)) + F.col(f"d.{c}")

    no_higher = F.coalesce(F.col("new_peak"), F.lit(float("-inf"))) < F.col("old_peak")
    no_worse = F.coalesce(F.col("new_worst"), F.lit(1 << 62)) > F.col("old_worst")
    stale = (F.coalesce((F.col("old_peak") >= F.col("c.peak_power_kw")) & no_higher, F.lit(False))
             | F.coalesce((F.col("old_worst") <= F.col("c.worst")) & no_worse, F.lit(False)))
    return (j.select(*CELL, *(total(c).cast(_DECIMAL if c in SUMS.values() else "bigint").alias(c) for c in ADDITIVE),
                     F.greatest("c.peak_power_kw", "new_peak").alias("peak_power_kw"), F.least("c.worst", "new_worst").alias("worst"),
                     stale.alias("_stale"))
            .withColumn("stale", F.col("_stale") & (F.col("readings") > 0)).drop("_stale"))


# --- the stored log -------------------------------------------------------------------------------------

CELLS_SCHEMA = ("meter_id string, hour_ts timestamp_ntz, " + ", ".join(f"{c} {_DECIMAL}" for c in SUMS.values())
                + ", power_units bigint, readings bigint, peak_power_kw double, worst bigint, v int")


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], CELLS_SCHEMA)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The newest value of every cell that has readings."""
    rest = [c for c in _log(spark, path).columns if c not in (*CELL, "v")]
    newest = _log(spark, path).repartition(*CELL).groupBy(*CELL).agg(F.max_by(F.struct(*rest), "v").alias("n"))
    return newest.select(*CELL, "n.*").filter("readings > 0")


def cells_version(spark: SparkSession, path: str) -> int | None:
    """The table version that the cells stand at: the newest folder that was written to its end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    numbers = []
    for status in fs.listStatus(folder):
        found = re.fullmatch(r"v=(\d+)", status.getPath().getName())
        if found and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            numbers.append(int(found[1]))
    return max(numbers, default=None)


def refresh_cells(spark: SparkSession, root: str, path: str, rules: Rules = RULES) -> dict:
    """Bring the cells at ``path`` to the newest version of the table at ``root``; returns the ``version``, and how many cells
    were ``touched`` and how many of them ``recomputed``. Only the touched cells are read, computed and written. A
    refresh that was cut short is repeated by the next one."""
    now = version(spark, root)
    at = cells_version(spark, path)
    if now is None or at == now.number:
        return {"version": at, "touched": 0, "recomputed": 0}
    changes = shared_dir(spark, "cell-changes")
    cell_changes(changed_rows(spark, root, at, now.number), rules.power_decimals).write.parquet(changes)
    touched = spark.read.parquet(changes)
    staged = shared_dir(spark, "cells-merged")
    known = _log(spark, path).filter(F.col("v") <= (at or 0)).join(touched.select(*CELL), list(CELL), "left_semi")
    rest = [c for c in known.columns if c not in (*CELL, "v")]
    known = known.repartition(*CELL).groupBy(*CELL).agg(F.max_by(F.struct(*rest), "v").alias("n")).select(*CELL, "n.*").filter("readings > 0")
    merged_cells(known, touched).write.parquet(staged)
    merged = spark.read.parquet(staged)
    # the extremes of stale cells, out of the files that their hours and meters select
    stale = merged.filter("stale").select(*CELL)
    span = stale.groupBy(F.year("hour_ts").alias("year"), F.month("hour_ts").alias("month")).agg(
        F.min("hour_ts").alias("a"), F.timestamp_add("HOUR", F.lit(1), F.max("hour_ts")).alias("z"),
        F.min("meter_id").alias("low"), F.max("meter_id").alias("high"))
    near = (live_files(spark, root, now).join(span, ["year", "month"])
            .filter((F.col("last_ts") >= F.col("a")) & (F.col("first_ts") < F.col("z"))
                    & (F.col("last_meter") >= F.col("low")) & (F.col("first_meter") <= F.col("high"))))
    files = [r["file"] for r in near.select("file").collect()]
    rows = read_files(spark, root, files).withColumn("hour_ts", R.hour_ts()).join(stale, list(CELL), "left_semi")
    fresh = rows.groupBy(*CELL).agg(F.max("power_kw").alias("_peak"), F.min(worst_status_key()).alias("_worst"))
    out = merged if not files else (
        merged.join(fresh, list(CELL), "left")
        .withColumn("peak_power_kw", F.when(F.col("stale"), F.col("_peak")).otherwise(F.col("peak_power_kw")))
        .withColumn("worst", F.when(F.col("stale"), F.col("_worst")).otherwise(F.col("worst"))).drop("_peak", "_worst"))
    out.drop("stale").repartitionByRange("meter_id", "hour_ts").sortWithinPartitions("meter_id", "hour_ts") \
        .write.mode("overwrite").parquet(f"{path}/v={now.number}")
    count = merged.agg(F.count(F.lit(1)).alias("touched"), F.count_if("stale").alias("recomputed")).first()
    for folder in (changes, staged):
        delete_path(spark, folder)
    return {"version": now.number, **count.asDict()}


def fold_cells(spark: SparkSession, path: str) -> DataFrame:
    """The log as one folder of its newest version, at a new place in the shared folder; returns it for reading. The caller
    puts it in the old one's place when no reader needs that any more."""
    at = cells_version(spark, path)
    new = shared_dir(spark, "cells-folded")
    read_cells(spark, path).write.parquet(f"{new}/v={at or 0}")
    return _log(spark, new)


__all__ = ["cell_changes", "cells_of", "cells_version", "changed_rows", "fold_cells", "hourly_from_cells", "merged_cells", "read_cells",
           "refresh_cells"]
