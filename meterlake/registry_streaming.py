"""Registered queries for the streaming operators (land files, run availableNow, read the result)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .rules import CURATED_COLUMNS
from .session import shared_dir
from .sources.compaction import cluster, compact
from .sources.standin import as_raw_frame, events_readings, standin_raw_frame, standin_readings
from .sources.versions import commit, read_version, write_files
from .streaming import (dead_letters, health_alerts_stream, incremental_ingest, outage_spells_stream, stage_landed,
                        versioned_ingest)
from .testdata import curated_standin

# Header spellings that the rename knows, see registry_curation.
from .registry_curation import VARIANT_HEADERS


def _quarter_files(raw: DataFrame) -> int:
    """Files of a quarter of a landing: one for every two splits of its input, so that no file grows with the tables."""
    return -(-raw.rdd.getNumPartitions() // 2)


def q_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in raw CSV landed as files dealt into 4 equal lots, ingested one lot per micro-batch; equals batch curation."""
    land = shared_dir(spark, "ingest-landing")
    raw = standin_raw_frame(spark, sf_dir)
    quarter = _quarter_files(raw)
    raw.repartition(4 * quarter).write.option("header", True).csv(land)
    table = shared_dir(spark, "ingest-table")
    incremental_ingest(spark, land, table, max_files_per_trigger=quarter)
    return spark.read.parquet(table).select(*CURATED_COLUMNS)


def q_versioned_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing as versions of a table, a quarter of it landed twice; the newest version, packed and clustered, equals
    batch curation."""
    land, root = shared_dir(spark, "versioned-landing"), shared_dir(spark, "versioned-table")
    raw = standin_raw_frame(spark, sf_dir)
    quarter = _quarter_files(raw)
    raw.repartition(4 * quarter).write.option("header", True).csv(f"{land}/first")
    checkpoint = versioned_ingest(spark, land, root, max_files_per_trigger=2 * quarter)["checkpoint"]
    raw.filter(F.col("meter").startswith("BR") & (F.month("x_Timestamp") <= 6)).write.option("header", True).csv(f"{land}/again")
    versioned_ingest(spark, land, root, checkpoint)
    compact(spark, root)
    return read_version(spark, root)


def q_clustered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of a year of one town's meters out of a clustered version; other files are not opened."""
    root = shared_dir(spark, "clustered-table")
    commit(spark, root, None, write_files(spark, curated_standin(spark, sf_dir), root))
    cluster(spark, root)
    return read_version(spark, root, since="1995-02-01", until="1995-05-01").filter(F.col("meter_id").startswith("BR"))


def _land_two_orders(spark: SparkSession, readings: DataFrame, land: str) -> None:
    """One landing with two header orders and spellings."""
    raw = as_raw_frame(readings)
    first = F.col("meter").startswith("BR")
    raw.filter(first).write.option("header", True).csv(f"{land}/own")
    turned = raw.filter(~first).toDF(*VARIANT_HEADERS)
    turned.select(*(F.col(f"`{c}`") for c in reversed(VARIANT_HEADERS))).write.option("header", True).csv(f"{land}/turned")


def q_health_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings derived from ``events`` landed as CSV with two header orders, alert windows via the watermarked stream."""
    land = shared_dir(spark, "alerts-landing")
    _land_two_orders(spark, events_readings(spark, sf_dir), land)
    sink = shared_dir(spark, "alerts-sink")
    health_alerts_stream(spark, land, sink)
    return spark.read.parquet(sink)


def q_outage_spells_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of the stand-in readings that the stream has closed."""
    land, sink = shared_dir(spark, "spells-landing"), shared_dir(spark, "spells-sink")
    _land_two_orders(spark, standin_readings(spark, sf_dir), land)
    outage_spells_stream(spark, land, sink)
    return spark.read.parquet(sink)


def q_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of two landings, by reason: the second holds the first day of every month, nearly all of it
    behind the watermark."""
    land, checkpoint = shared_dir(spark, "dead-landing"), shared_dir(spark, "dead-checkpoint")
    readings = standin_readings(spark, sf_dir)
    late = F.dayofmonth("reading_ts") == 1
    _land_two_orders(spark, readings.filter(~late), f"{land}/first")
    stage_landed(spark, land, checkpoint)
    _land_two_orders(spark, readings.filter(late), f"{land}/second")
    stage_landed(spark, land, checkpoint)
    return dead_letters(spark, checkpoint).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def registered() -> dict:
    return {"incremental_ingest": q_incremental_ingest, "health_alerts_stream": q_health_alerts_stream,
            "versioned_ingest": q_versioned_ingest, "clustered_table": q_clustered_table,
            "outage_spells_stream": q_outage_spells_stream, "dead_letters": q_dead_letters}
