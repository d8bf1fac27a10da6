"""Curated table in versions: files that never change, a list of live files for each version, one atomic commit.

Under the table's root lie

- ``data/commit=<id>/year=…/month=…/part-*.parquet``: the rows; a file is written once,
- ``lists/<id>``: Parquet, the live files of one version with row counts, sizes and the range of times and meters,
- ``changes/<id>``: Parquet, the rows (with ``_sign``) by which a version differs from the one before, if its writer kept them,
- ``versions/<number>.json``: a committed version; it names its list.

A version exists from the moment its small file is renamed into place, which fails if another writer was first.
A reader takes the highest number when it starts and reads that version's files to the end; files of an
unfinished or lost commit are in no list, so nobody sees them. ``vacuum`` removes files and lists that
no recent version uses.

The rename is atomic on HDFS and local disks. Lists are handled as DataFrames; what reaches the driver are the
paths of the files that a read selects, as with any file scan.
"""
from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..rules import CURATED_COLUMNS
from ..session import delete_path, path_exists
from .curated import CURATED_TYPES, partition_predicate, write_curated

LIST_SCHEMA = ("file string, year int, month int, bytes bigint, rows bigint, first_ts timestamp_ntz, last_ts timestamp_ntz, "
               "first_meter string, last_meter string")
FILE = "_file"


class CommitConflict(RuntimeError):
    """Another writer has committed the same version number."""


@dataclass(frozen=True)
class Version:
    """A committed version: its number, the id of its file list, and the last batch of each stream that it holds."""

    number: int
    list_id: str
    batches: dict[str, int] = field(default_factory=dict)


# --- commits --------------------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, f"{root}/versions")
    if not fs.exists(folder):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The given version, or the newest; None for a table without any."""
    if number is None:
        number = max(_numbers(spark, root), default=None)
        if number is None:
            return None
    fs, path = _fs(spark, f"{root}/versions/{number:012d}.json")
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    got = json.loads(text)
    return Version(number, got["list"], got["batches"])


def commit(spark: SparkSession, root: str, base: Version | None, live: DataFrame, batches: dict[str, int] | None = None,
           changes: DataFrame | None = None) -> Version:
    """Make ``live`` (rows of ``LIST_SCHEMA``) the files of the version after ``base``; ``CommitConflict`` if that number is taken.
    ``changes``: curated rows with ``_sign``, those that the version gains (1) and loses (-1), kept for ``kept_changes``."""
    new = Version((base.number if base else 0) + 1, uuid.uuid4().hex, {**(base.batches if base else {}), **(batches or {})})
    live.coalesce(1 + (base is not None)).write.parquet(f"{root}/lists/{new.list_id}")
    if changes is not None:
        changes.write.parquet(f"{root}/changes/{new.list_id}")
    publish(spark, root, new)
    return new


def publish(spark: SparkSession, root: str, new: Version) -> None:
    """The atomic step: the version's file appears whole under its number, or not at all."""
    jvm = spark._jvm
    fs, waiting = _fs(spark, f"{root}/versions/.{new.list_id}")
    out = fs.create(waiting, False)
    try:
        out.write(bytearray(json.dumps({"list": new.list_id, "batches": new.batches}).encode()))
    finally:
        out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{new.number:012d}.json")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(waiting), fs.makeQualified(place), no_overwrite)
    except Py4JJavaError as e:
        fs.delete(waiting, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise CommitConflict(f"version {new.number} of {root} is taken") from e
        raise


# --- files ----------------------------------------------------------------------------------------------

def live_files(spark: SparkSession, root: str, at: Version | None) -> DataFrame:
    """The live files of a version; none for None."""
    if at is None:
        return spark.createDataFrame([], LIST_SCHEMA)
    return spark.read.schema(LIST_SCHEMA).parquet(f"{root}/lists/{at.list_id}")


def kept_changes(spark: SparkSession, root: str, since: int, until: int) -> DataFrame | None:
    """The changes of all versions after ``since`` up to ``until``, one after the other; None if one of them has none kept."""
    numbers = range(since + 1, until + 1)
    if not numbers or not set(numbers) <= set(_numbers(spark, root)):
        return None
    paths = [f"{root}/changes/{version(spark, root, n).list_id}" for n in numbers]
    if not all(path_exists(spark, f"{p}/_SUCCESS") for p in paths):
        return None
    return spark.read.schema(f"{_schema()}, _sign bigint").parquet(*paths)


def _schema() -> str:
    return ", ".join(f"{c} {CURATED_TYPES[c]}" for c in CURATED_COLUMNS)


def read_files(spark: SparkSession, root: str, files: list[str], columns: tuple[str, ...] = CURATED_COLUMNS) -> DataFrame:
    """Rows of the given files (paths below ``data/``), with ``_file``."""
    if not files:
        return spark.createDataFrame([], _schema()).withColumn(FILE, F.lit("")).select(*columns, FILE)
    df = spark.read.schema(_schema()).option("basePath", f"{root}/data").parquet(*(f"{root}/data/{f}" for f in files))
    return df.select(*columns, _relative().alias(FILE))


def _relative() -> Column:
    """Path below ``data/`` of a row's file."""
    return F.concat(F.lit("commit="), F.element_at(F.split(F.col("_metadata.file_path"), "/commit="), -1))


def written_files(spark: SparkSession, root: str, commit_id: str) -> DataFrame:
    """List entries of the files of one commit, from their times and meters. A file lies in one month, gathered as a set:
    Spark then keeps the few files of a task in an object hash table, where the meters' strings alone would have made it
    sort all rows by file."""
    df = spark.read.schema(_schema()).option("basePath", f"{root}/data").parquet(f"{root}/data/commit={commit_id}")
    return (df.select(_relative().alias("file"), "year", "month", F.col("_metadata.file_size").alias("bytes"), "reading_ts", "meter_id")
            .groupBy("file", "bytes")
            .agg(F.collect_set(F.struct("year", "month"))[0].alias("at"), F.count(F.lit(1)).alias("rows"), F.min("reading_ts").alias("first_ts"), F.max("reading_ts").alias("last_ts"),
                 F.min("meter_id").alias("first_meter"), F.max("meter_id").alias("last_meter"))
            .select("file", "at.year", "at.month", "bytes", "rows", "first_ts", "last_ts", "first_meter", "last_meter"))


def write_files(spark: SparkSession, df: DataFrame, root: str, laid_out: bool = False) -> DataFrame:
    """Write curated rows as files of a new commit; returns their list entries, read once from the files and kept with
    the lists (they are no version's list, and go with the next ``vacuum``)."""
    commit_id = f"c{uuid.uuid4().hex}"
    write_curated(df, f"{root}/data/commit={commit_id}", mode="error", laid_out=laid_out)
    path = f"{root}/lists/{commit_id}"
    written_files(spark, root, commit_id).coalesce(1).write.parquet(path)
    return spark.read.schema(LIST_SCHEMA).parquet(path)


def selected(files: DataFrame, since=None, until=None, meters: list[str] | None = None) -> DataFrame:
    """The files that can hold rows from ``since`` to before ``until`` of any of ``meters``, by their ranges."""
    if since is not None:
        files = files.filter(F.col("last_ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        files = files.filter(F.col("first_ts") < F.lit(until).cast("timestamp_ntz"))
    if meters is not None:
        among = F.array(*[F.lit(m) for m in sorted(meters)]).cast("array<string>")
        files = files.filter(F.exists(among, lambda m: m.between(F.col("first_meter"), F.col("last_meter"))))
    return files


def read_version(spark: SparkSession, root: str, since=None, until=None, meters: list[str] | None = None,
                 number: int | None = None, columns: tuple[str, ...] = CURATED_COLUMNS) -> DataFrame:
    """Rows of one version (the newest by default): ``since`` inclusive, ``until`` exclusive, ``meters`` if given. Files
    outside those ranges are not opened; the version stays the same however long the result is used."""
    files = selected(live_files(spark, root, version(spark, root, number)), since, until, meters)
    df = read_files(spark, root, [r["file"] for r in files.select("file").collect()])
    cond = partition_predicate(since, until)
    df = df if cond is None else df.filter(cond)
    return (df if meters is None else df.filter(F.col("meter_id").isin(meters))).select(*columns)


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than_s: float = 86_400.0) -> int:
    """Remove files and lists that none of the newest ``keep`` versions uses and that are older than ``older_than_s``
    (a running commit's files are in no list yet); returns the number of data files removed."""
    numbers = _numbers(spark, root)
    kept = [version(spark, root, n) for n in numbers[-max(keep, 1):]]
    if not kept:
        return 0
    limit = F.lit(time.time() - older_than_s).cast("timestamp")
    used = None
    for v in kept:
        files = live_files(spark, root, v).select("file")
        used = files if used is None else used.unionByName(files)
    there = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/data")
             .filter(F.col("modificationTime") < limit)
             .select(F.concat(F.lit("commit="), F.element_at(F.split("path", "/commit="), -1)).alias("file")))
    dead = [r["file"] for r in there.join(used, "file", "left_anti").collect()]
    for n in numbers[:-max(keep, 1)]:
        delete_path(spark, f"{root}/versions/{n:012d}.json")
    for file in dead:
        delete_path(spark, f"{root}/data/{file}")
    names = {v.list_id for v in kept}
    for folder in ("lists", "changes"):
        fs, lists = _fs(spark, f"{root}/{folder}")
        for status in fs.listStatus(lists) if fs.exists(lists) else ():
            if status.getPath().getName() not in names and status.getModificationTime() < (time.time() - older_than_s) * 1000:
                fs.delete(status.getPath(), True)
    return len(dead)


__all__ = ["CommitConflict", "LIST_SCHEMA", "Version", "commit", "kept_changes", "live_files", "publish", "read_files", "read_version",
           "selected", "vacuum", "version", "write_files", "written_files"]
