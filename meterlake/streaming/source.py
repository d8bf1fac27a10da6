"""Streaming sources over landed raw CSV files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _reader(spark: SparkSession, max_files_per_trigger: int | None, pattern: str):
    r = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r


def raw_line_stream(spark: SparkSession, landing: str, exclude: str | None = "Aggregated",
                    max_files_per_trigger: int | None = None, pattern: str = "*.csv") -> DataFrame:
    """Landed files as lines with their file (``value``, ``file``), for ``parse_lines`` inside a micro-batch."""
    df = _reader(spark, max_files_per_trigger, pattern).format("text").load(landing)
    if exclude:
        df = df.filter(~F.col("_metadata.file_name").contains(exclude))
    return df.select("value", F.col("_metadata.file_path").alias("file"))
