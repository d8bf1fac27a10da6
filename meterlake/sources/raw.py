"""Raw interval CSV: read all columns as strings, then map header spellings."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..rules import BASE_COLUMNS
from ..session import shared_dir

# Exact header of the interval files, in file order.
RAW_HEADERS = ("x_Timestamp", "t_kWh", "z_Avg Voltage (Volt)", "z_Avg Current (Amp)", "y_Freq (Hz)", "meter")

# Header spellings produced by different crawler classifiers
# (compared after lower() and strip()), mapped to curated names.
RENAMES = {
    "x_timestamp": "reading_ts",
    "t_kwh": "energy_kwh",
    "z_avg voltage (volt)": "avg_voltage",
    "z_avg_voltage (volt)": "avg_voltage",
    "z_avg_voltage_(volt)": "avg_voltage",
    "z_avg current (amp)": "avg_current",
    "z_avg_current (amp)": "avg_current",
    "z_avg_current_(amp)": "avg_current",
    "y_freq (hz)": "frequency_hz",
    "y_freq_(hz)": "frequency_hz",
    "meter": "meter_id",
}


#: what only a header line holds: one of the interval files' own column names
HEADER_MARK = r"(?i)x_timestamp|t_kwh|y_freq|z_avg"


def _files(reader, pattern: str):
    return reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")


def _of_interval_files(df: DataFrame, exclude: str | None) -> DataFrame:
    """Without the files whose *name* contains ``exclude``; folders are free to."""
    return df.filter(~F.col("_metadata.file_name").contains(exclude)) if exclude else df


def _marked(mark: str) -> Column:
    """Whether a line holds the mark; each of the usual names has a ``_``, which is faster to look for."""
    found = F.col("value").rlike(mark)
    return F.col("value").contains("_") & found if mark == HEADER_MARK else found


def header_lines(lines: DataFrame, mark: str = HEADER_MARK) -> DataFrame:
    """``file, header`` of every file with lines (``value``, ``file``); null where no line is a header. One pass, and one
    row of a task for each file it reads. (The files are gathered in an object hash table, for the set's sake; with ``min``
    alone Spark would sort all lines by file.)"""
    kinds = F.collect_set(_marked(mark))
    header = F.min(F.when(_marked(mark), F.col("value")))
    return lines.groupBy("file").agg(F.when(F.array_contains(kinds, True), header).alias("header"))


def _known(name: Column, mapping: dict[str, str]) -> Column:
    """The curated name of a header cell, or its own in lower case."""
    lower = F.lower(F.trim(name))
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), lower), lower) if pairs else lower


class Headers:
    """The headers of many files: the column names of the fullest one, and where each file has them.

    ``of_file`` (``file, header``) is written to the shared folder once. What reaches the driver is the fullest
    header (that with most curated columns, or else the most frequent); any number of files and of different
    headers is matched to it by Spark.
    """

    def __init__(self, of_file: DataFrame, mapping: dict[str, str]):
        spark = of_file.sparkSession
        path = shared_dir(spark, "headers")
        of_file.write.parquet(path)
        self.of_file = spark.read.schema(of_file.schema).parquet(path)
        seen = self.of_file.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("header").isNull(), F.col("file"))).alias("bare"),
                                F.max(F.size(F.split("header", ","))).alias("width")).first()
        self.n_files, self.bare, self.width, self.names = seen["n"], seen["bare"], seen["width"] or 0, []
        if self.bare is not None or not self.width:
            return
        cells = F.from_csv(F.regexp_replace("header", "^\ufeff", ""), ", ".join(f"_c{i} string" for i in range(self.width)))
        own = (self.of_file.select("file", "header", cells.alias("c"))
               .select("file", "header", F.array(*(F.col(f"c._c{i}") for i in range(self.width))).alias("cells"))
               .withColumn("known", F.transform("cells", lambda c: _known(F.coalesce(c, F.lit("")), mapping))))
        among = F.array(*(F.lit(m) for m in sorted(set(mapping.values())))).cast("array<string>")
        fullest = (own.groupBy("header", "cells", "known").agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.size(F.array_intersect("known", among)).desc(), F.desc("n"), "header").first())
        names = list(fullest["cells"])
        while names and names[-1] is None:
            names.pop()
        self.names = [(c or "").strip() for c in names]
        wanted = fullest["known"][:len(self.names)]
        places = F.array(*(F.array_position("known", F.lit(w)) for w in wanted))
        self.commonest = [fullest["known"].index(w) + 1 for w in wanted]
        self.files = own.select("file", "header", places.alias("places"))
        curated = [i for i, n in enumerate(self.names) if n.lower().strip() in mapping]
        if curated:
            lacking = F.array_compact(F.array(*(F.when(F.col("places")[i] == 0, F.lit(self.names[i])) for i in curated)))
            bad = self.files.select("file", "header", lacking.alias("lacking")).filter(F.size("lacking") > 0).first()
            if bad:
                raise ValueError(f"{bad['file']}: no column for {bad['lacking']} in its header {bad['header']!r}")

    def in_order(self, rows: DataFrame) -> DataFrame:
        """Rows with cells ``_c0 …`` and ``_file`` as columns of the names; other columns stay."""
        rest = [c for c in rows.columns if not c.startswith("_c") and c != "_file"]
        usual = F.array(*(F.lit(p) for p in self.commonest)).cast("array<bigint>")
        others = self.files.filter(F.col("places") != usual).select(F.col("file").alias("_file"), F.col("places").alias("_places"))
        if others.isEmpty():
            return rows.select(*(F.col(f"_c{p - 1}").alias(n) for p, n in zip(self.commonest, self.names)), *rest)
        cells = F.array(*(F.col(f"_c{i}") for i in range(self.width)))
        joined = rows.join(others, "_file", "left")
        # a column that is no curated one may be absent from a file: place 0, null
        picked = (F.when(F.col("_places").isNull(), F.col(f"_c{p - 1}")).otherwise(F.get(cells, F.col("_places")[i].cast("int") - 1)).alias(n)
                  for i, (p, n) in enumerate(zip(self.commonest, self.names)))
        return joined.select(*picked, *rest)


def read_raw_csv(spark: SparkSession, paths: str | Iterable[str], exclude: str | None = "Aggregated",
                 keep_file: bool = False, pattern: str = "*.csv", mapping: dict[str, str] | None = None,
                 mark: str = HEADER_MARK) -> DataFrame:
    """Headered interval CSVs, every column a string (no inference pass).

    Each file is read by its own header: the result has the columns of the
    fullest header, and a file whose header has other spellings or another
    order gives each column by its curated name (``mapping``). Only the fullest
    header reaches the driver; rows of files with another order meet their
    places in a join, which Spark broadcasts or shuffles by its size.

    Files whose name contains ``exclude`` (the daily ``*Aggregated*`` files,
    another layout) are left out. A file without a header (``mark``), or whose
    header lacks a column, is an error. ``keep_file`` adds ``source_file`` (file
    name, from the hidden ``_metadata`` column) for per-file accounting.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    mapping = RENAMES if mapping is None else mapping
    lines = _of_interval_files(_files(spark.read.format("text"), pattern).load(paths), exclude)
    headers = Headers(header_lines(lines.select("value", F.col("_metadata.file_path").alias("file")), mark), mapping)
    if not headers.n_files:
        raise FileNotFoundError(f"no {pattern} files with lines under {paths}")
    if headers.bare is not None:
        raise ValueError(f"{headers.bare} has no header line")
    schema = ", ".join(f"_c{i} string" for i in range(headers.width))
    df = _of_interval_files(_files(spark.read.schema(schema).option("header", True), pattern).csv(paths), exclude)
    extra = [F.col("_metadata.file_name").alias("source_file")] if keep_file else []
    return headers.in_order(df.select("*", F.col("_metadata.file_path").alias("_file"), *extra))


def parse_lines(lines: DataFrame, mapping: dict[str, str] | None = None, mark: str = HEADER_MARK, keep: bool = False) -> DataFrame:
    """Text rows (``value``, ``file``) of whole CSV files as ``read_raw_csv`` gives them: each file by its own header.
    ``keep`` keeps the line itself and its file, as ``_line`` and ``_source``."""
    headers = Headers(header_lines(lines, mark), RENAMES if mapping is None else mapping)
    if headers.bare is not None:
        raise ValueError(f"{headers.bare} has no header line")
    extra = {"_line": F.col("value"), "_source": F.col("file")} if keep else {}
    if not headers.width:
        return lines.sparkSession.createDataFrame([], ", ".join(f"`{h}` string" for h in (*RAW_HEADERS, *extra)))
    schema = ", ".join(f"_c{i} string" for i in range(headers.width))
    cells = (lines.filter(~_marked(mark) & (F.trim("value") != ""))
             .select(F.from_csv("value", schema).alias("c"), F.col("file").alias("_file"), *(e.alias(n) for n, e in extra.items()))
             .select("c.*", "_file", *extra))
    return headers.in_order(cells)


def normalize_columns(df: DataFrame, mapping: dict[str, str] | None = None,
                      passthrough: Iterable[str] = ("source_file",)) -> DataFrame:
    """Rename case/space variants to curated names and keep the six required columns.

    Raises ``ValueError`` naming the missing columns.
    """
    mapping = RENAMES if mapping is None else mapping
    found: dict[str, str] = {}
    for c in df.columns:
        target = mapping.get(c.lower().strip())
        if target and target not in found:
            found[target] = c
    missing = [c for c in BASE_COLUMNS if c not in found]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)} among {', '.join(df.columns)}")
    keep = [F.col(f"`{found[c]}`").alias(c) for c in BASE_COLUMNS]
    keep += [F.col(c) for c in passthrough if c in df.columns]
    return df.select(*keep)
