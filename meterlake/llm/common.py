"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

ARROW_ROWS = 1000
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once for each application, as ``--py-files`` does.

    Whole texts travel in Arrow batches: unless the session has its own setting, they hold ``ARROW_ROWS`` rows
    instead of Spark's 10,000, so that a batch of long texts stays small on both sides."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that first ships the package."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__ = query.__name__
    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared checkpoint directory and read back: the lineage is
    cut, the result survives lost executors and is not computed twice."""
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)

def text_batches(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts (or binary values) hold about ``limit`` bytes, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        length = pa.compute.fill_null(pa.compute.binary_length(batch.column(name)), 0)
        offsets = pa.compute.cumulative_sum(length.cast(pa.int64())).to_numpy()
        first = 0
        while first < batch.num_rows:
            start = offsets[first - 1] if first else 0
            last = max(int(offsets.searchsorted(start + limit, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first = last

__all__ = ["crc_mod", "read_table", "shared_dir", "ship_package", "shipped", "stored", "text_batches"]
