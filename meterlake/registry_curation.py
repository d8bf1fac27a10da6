"""Registered queries for the curation operators (sources, sinks, derivations, quality).

File-based operators write under the session's shared checkpoint folder
(``meterlake.session.shared_dir``), one fresh folder per call.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .functions import readings as RD
from .operators import clean as CL, quality as QA
from .plans import consumption as C
from .rules import BASE_COLUMNS, CURATED_COLUMNS
from .session import shared_dir
from .sources import curated as CU, raw as RAW, standin as ST
from .testdata import curated_standin

# Header spellings used to exercise the rename (each one is listed in RENAMES after lower()/strip()).
VARIANT_HEADERS = ("X_Timestamp ", " t_KWH", "z_avg_voltage (volt)", "Z_Avg_Current_(Amp)", "y_freq_(hz)", " Meter")


def typed_from_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.typed_readings(RAW.normalize_columns(ST.standin_raw_frame(spark, sf_dir)))


def q_normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ST.standin_raw_frame(spark, sf_dir).toDF(*VARIANT_HEADERS)
    return CL.typed_readings(RAW.normalize_columns(raw))


def q_read_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the stand-in as raw CSV with two header orders and spellings, next to daily ``Aggregated`` files in the
    same folder; read back the interval files."""
    land = shared_dir(spark, "landing")
    raw = ST.standin_raw_frame(spark, sf_dir)
    bareilly = F.col("meter").startswith("BR")
    raw.filter(bareilly).write.option("header", True).csv(f"{land}/SM_interval")
    turned = raw.filter(~bareilly).toDF(*VARIANT_HEADERS)
    turned.select(*(F.col(f"`{c}`") for c in reversed(VARIANT_HEADERS))).write.option("header", True).csv(f"{land}/SM_other")
    daily = (ST.standin_readings(spark, sf_dir)
             .groupBy(F.col("meter_id").alias("meter"), F.to_date("reading_ts").cast("string").alias("Date"))
             .agg(F.sum("energy_kwh").cast("string").alias("t_kWh")))
    land_aggregated(daily, land)
    return CL.typed_readings(RAW.normalize_columns(RAW.read_raw_csv(spark, land)))


def land_aggregated(daily: DataFrame, land: str) -> None:
    """Daily files under names that say ``Aggregated``, as the reference's cleaner knows them."""
    spark = daily.sparkSession
    daily.write.option("header", True).csv(f"{land}/daily")
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{land}/daily")
    fs = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(files):
        path = status.getPath()
        if path.getName().endswith(".csv"):
            fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"SM_Aggregated_{path.getName()}"))


def _written_curated(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "curated")
    CU.write_curated(curated_standin(spark, sf_dir), path)
    return path


def q_write_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_written_curated(spark, sf_dir)).select(*CURATED_COLUMNS)


def q_read_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CU.read_curated(spark, _written_curated(spark, sf_dir), since="1997-03-15", until="1999-07-01")


def q_register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_curated(spark, sf_dir)
    return CU.register_table(spark, f"meter_readings_{path[-12:]}", path).select(*CURATED_COLUMNS)


def q_write_clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "clean-csv")
    CU.write_clean_csv(CL.clean(ST.standin_readings(spark, sf_dir)), path)
    same = {c: c for c in BASE_COLUMNS}
    raw = RAW.read_raw_csv(spark, path, exclude=None, mapping=same, mark="^reading_ts,")
    return CL.typed_readings(RAW.normalize_columns(raw, same))


def q_row_count_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = Observation("curate")
    df = curated_standin(spark, sf_dir).observe(obs, F.count(F.lit(1)).alias("rows"))
    CU.write_curated(df, shared_dir(spark, "curated-observed"))
    return spark.createDataFrame([(int(obs.get["rows"]),)], "rows_written bigint")


def _cols(*cols) -> callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return curated_standin(spark, sf_dir).select(*[c() if callable(c) else c for c in cols])
    return run


def registered() -> dict:
    typed = lambda s, d: CL.typed_readings(ST.standin_readings(s, d))
    return {
        "read_raw_csv": q_read_raw_csv,
        "normalize_columns": q_normalize_columns,
        "typed_readings": typed_from_strings,
        "write_curated": q_write_curated,
        "read_curated": q_read_curated,
        "register_table": q_register_table,
        "write_clean_csv": q_write_clean_csv,
        "row_count_metric": q_row_count_metric,
        "curate": curated_standin,
        "time_attributes": _cols("meter_id", "reading_ts", "year", "month", "day", "hour", "day_of_week", "is_weekend"),
        "power_kw": _cols("meter_id", "reading_ts", "avg_voltage", "avg_current", "power_kw"),
        "voltage_band": _cols("meter_id", "reading_ts", "avg_voltage", "voltage_band"),
        "current_band": _cols("meter_id", "reading_ts", "avg_current", "current_band"),
        "power_band": _cols("meter_id", "reading_ts", "power_kw", "power_band"),
        "health_score": _cols("meter_id", "reading_ts", "health_score"),
        "health_status": _cols("meter_id", "reading_ts", "health_status"),
        "town": _cols("meter_id", "reading_ts", lambda: RD.town().alias("town")),
        "drop_nulls": lambda s, d: CL.drop_nulls(typed(s, d)),
        "range_filter": lambda s, d: CL.range_filter(typed(s, d)),
        "dedup_exact": lambda s, d: CL.dedup_exact(typed(s, d)),
        "dedup_key": lambda s, d: CL.clean(ST.standin_readings(s, d)),
        "quality_report": lambda s, d: QA.quality_report(
            ST.standin_readings(s, d).withColumn("source", RD.town()), source="source"),
        "rejects": lambda s, d: QA.rejects(ST.standin_readings(s, d)),
        "summary_stats": lambda s, d: QA.summary_stats(curated_standin(s, d)),
        "summary_ids": lambda s, d: QA.id_summary(curated_standin(s, d)),
        "curated_checks": lambda s, d: QA.curated_checks(ST.standin_readings(s, d), curated_standin(s, d)),
        "completeness": lambda s, d: C.q28_completeness(curated_standin(s, d), fill_calendar=True, n=None),
    }
