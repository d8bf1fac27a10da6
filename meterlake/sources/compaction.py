"""Maintenance of a versioned table: small files packed together, and rows clustered by meter and time."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .versions import CommitConflict, FILE, commit, live_files, read_files, selected, version, write_files

TARGET_BYTES = 128 << 20
#: rows that one task sorts while clustering: about 0.6 GB of curated rows
SORT_ROWS = 2_000_000
ATTEMPTS = 5


def bins(files: DataFrame, target_bytes: int = TARGET_BYTES, full: float = 0.75) -> DataFrame:
    """``file, year, month, bytes, bin`` of the files worth packing: in each month, files below ``full`` of the target are
    laid end to end in order of their first time, and cut at every full target; a bin of one file is left out."""
    small = files.filter(F.col("bytes") < int(target_bytes * full))
    month = Window.partitionBy("year", "month")
    before = F.sum("bytes").over(month.orderBy("first_ts", "file").rowsBetween(Window.unboundedPreceding, -1))
    binned = small.select("file", "year", "month", "bytes", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_bytes)).alias("bin"))
    return (binned.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("year", "month", "bin")))
            .filter("_n > 1").drop("_n"))


def interleaved(*values: Column, bits: int) -> Column:
    """One BIGINT of the low ``bits`` bits of each value in turn (a Z-order key)."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, v in enumerate(values):
            digit = F.shiftright(v.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(digit, bit * len(values) + k))
    return out


def meter_buckets(df: DataFrame, bits: int) -> DataFrame:
    """``meter_id, _bucket``: meters in order, in up to ``2**bits`` ranges of about as many meters (the number of the
    range partition that holds them)."""
    return (df.select("meter_id").distinct().repartitionByRange(1 << bits, "meter_id")
            .withColumn("_bucket", F.spark_partition_id().cast("bigint")))


def clustered(df: DataFrame, parts: int, bits: int = 6) -> DataFrame:
    """Curated rows in ``parts`` ranges of month and interleaved meter and time, so that a file holds few meters for a
    short time. A range with more rows than others is split by time and meter, which follow in the sort key."""
    hours = (F.col("day") - 1) * 24 + F.col("hour")
    when = F.floor(hours * F.lit(1 << bits) / F.lit(31 * 24))
    keyed = df.join(meter_buckets(df, bits), "meter_id").withColumn("_z", interleaved(F.col("_bucket"), when, bits=bits))
    order = ("year", "month", "_z", "meter_id", "reading_ts")
    return keyed.repartitionByRange(max(parts, 1), *order).sortWithinPartitions(*order).drop("_bucket", "_z")


def _replace(spark: SparkSession, root: str, choose, write) -> int:
    """Commit a version in which the files that ``choose(live)`` names are replaced by those that ``write(names)`` gives; again
    from the newest version if another writer was first. Returns the number of files replaced."""
    for attempt in range(ATTEMPTS):
        base = version(spark, root)
        live = live_files(spark, root, base)
        chosen = choose(live)
        names = [r["file"] for r in chosen.select("file").collect()]
        if not names:
            return 0
        new = write(chosen, names)
        files = live.join(spark.createDataFrame([(f,) for f in names], "file string"), "file", "left_anti").unionByName(new)
        try:
            commit(spark, root, base, files)
            return len(names)
        except CommitConflict:
            if attempt + 1 == ATTEMPTS:
                raise
    raise AssertionError("unreachable")


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack small files into ones of about ``target_bytes``; files that are large enough stay as they are. Returns the
    number of files replaced."""
    def write(chosen: DataFrame, names: list[str]) -> DataFrame:
        place = chosen.select(F.col("file").alias(FILE), F.col("bin").alias("_bin"))
        rows = read_files(spark, root, names).join(F.broadcast(place) if len(names) < 100_000 else place, FILE)
        packed = rows.hint("rebalance", "year", "month", "_bin").sortWithinPartitions("year", "month", "meter_id", "reading_ts")
        return write_files(spark, packed.drop("_bin", FILE), root, laid_out=True)

    return _replace(spark, root, lambda live: bins(live, target_bytes), write)


def cluster(spark: SparkSession, root: str, since=None, until=None, target_bytes: int = TARGET_BYTES, bits: int = 6) -> int:
    """Rewrite the files of a time range (all by default) in clustered order, in files of about ``target_bytes``, or of
    about ``SORT_ROWS`` rows where these take fewer bytes. Returns the number of files replaced."""
    def write(chosen: DataFrame, names: list[str]) -> DataFrame:
        size = chosen.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
        parts = max(-(-size["bytes"] // target_bytes), -(-size["rows"] // SORT_ROWS))
        rows = clustered(read_files(spark, root, names).drop(FILE), parts, bits)
        return write_files(spark, rows, root, laid_out=True)

    return _replace(spark, root, lambda live: selected(live, since, until), write)
