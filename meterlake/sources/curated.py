"""Curated Parquet table: year/month partitioned sink, pruned reader, catalog entry."""
from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..rules import CURATED_COLUMNS, PARTITION_COLUMNS

# fixed values: types of the curated table
CURATED_TYPES = {
    "reading_ts": "timestamp_ntz", "energy_kwh": "double", "avg_voltage": "double", "avg_current": "double",
    "frequency_hz": "double", "meter_id": "string", "day": "int", "hour": "int", "day_of_week": "string",
    "is_weekend": "boolean", "power_kw": "double", "voltage_band": "string", "current_band": "string",
    "power_band": "string", "health_score": "double", "health_status": "string", "year": "int", "month": "int",
}


def layout(df: DataFrame) -> DataFrame:
    """Clustering for the partitioned write.

    ``rebalance`` on the partition columns lets AQE split a large month into
    several write tasks of the advisory size (a plain ``repartition(year, month)``
    would put a whole month in one task). Rows are sorted by meter and time
    inside each file so Parquet min/max statistics prune meter and time filters.
    """
    return (df.hint("rebalance", *PARTITION_COLUMNS)
              .sortWithinPartitions(*PARTITION_COLUMNS, "meter_id", "reading_ts"))


def write_curated(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False,
                  max_records_per_file: int = 5_000_000, laid_out: bool = False) -> None:
    """Snappy Parquet partitioned by (year, month), clustered by ``layout``.

    ``laid_out=True``: ``df`` already went through ``layout`` (e.g. before its
    derived columns were added, so the shuffle and sort moved only the base
    columns). ``dynamic=True`` replaces only the months present in ``df``; otherwise
    an overwrite replaces the whole table, whatever the session's default is.
    """
    out = df.select(*CURATED_COLUMNS)
    if not laid_out:
        out = layout(out)
    w = (out.write.mode(mode).partitionBy(*PARTITION_COLUMNS)
         .option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file)
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    w.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = (),
                sort_by: tuple[str, ...] = (), dynamic: bool = False, laid_out: bool = False) -> None:
    """Snappy Parquet; with ``partition_by``, rows are first rebalanced on those columns.

    Without the rebalance every task would write one file into every
    partition folder it happens to hold (tasks × partitions small files).
    ``sort_by`` orders the rows of each file, so its statistics prune filters
    on those columns; ``dynamic=True`` replaces only the partitions in ``df``.
    ``laid_out=True``: the rows come in the order of the partitions already.
    """
    if partition_by and not laid_out:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = (df.write.mode(mode).option("compression", "snappy")
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _ym(x) -> int:
    if isinstance(x, str):
        x = dt.date.fromisoformat(x[:10])
    return x.year * 100 + x.month


def partition_predicate(since=None, until=None, ts: str = "reading_ts") -> Column | None:
    """Predicate on (year, month) derived from a time range, plus the exact row filter.

    The partition part lands in ``PartitionFilters`` (whole month folders are
    skipped); the ``reading_ts`` part is pushed to the Parquet reader.
    """
    ym = F.col("year") * 100 + F.col("month")
    cond = None
    if since is not None:
        cond = (ym >= _ym(since)) & (F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        c = (ym <= _ym(until)) & (F.col(ts) < F.lit(until).cast("timestamp_ntz"))
        cond = c if cond is None else cond & c
    return cond


def read_curated(spark: SparkSession, path: str, since=None, until=None,
                 columns: tuple[str, ...] | None = None) -> DataFrame:
    """Scan the curated table; ``since`` inclusive, ``until`` exclusive."""
    df = spark.read.parquet(path)
    cond = partition_predicate(since, until)
    if cond is not None:
        df = df.filter(cond)
    return df.select(*(columns or CURATED_COLUMNS))


def latest_partition(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """The latest (year, month) of a partitioned table that has a file, from the names of its folders; None without any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def values(at, name: str) -> list[tuple[int, object]]:
        found = ((re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()), s.getPath()) for s in fs.listStatus(at) if s.isDirectory())
        return sorted(((int(m[1]), p) for m, p in found if m), key=lambda v: -v[0])

    for year, in_year in values(folder, "year") if fs.exists(folder) else ():
        for month, in_month in values(in_year, "month"):
            if any(s.getPath().getName()[0] not in "._" and s.getLen() for s in fs.listStatus(in_month)):
                return year, month
    return None


def _plain(path: str) -> str:
    """A location without the ``file:`` scheme and trailing slashes."""
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """External Parquet table over ``path`` with the curated schema, its partitions discovered (MSCK REPAIR).

    A table of that name is kept if it lies at ``path``, and refused otherwise;
    nothing is dropped.
    """
    columns = ", ".join(f"{c} {CURATED_TYPES[c]}" for c in CURATED_COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'")
    at = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Location", "")
    if _plain(at) != _plain(path):
        raise ValueError(f"table {name} exists at {at or 'no location'}, not at {path}")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_clean_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned readings as headered CSV, globally sorted by meter and time.

    ``orderBy`` range-partitions on the sort key, so the part files are in
    order and no single task holds the whole set.
    """
    cols = ["reading_ts", "energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "meter_id"]
    (df.select(*cols).orderBy("meter_id", "reading_ts")
       .write.mode(mode).option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
