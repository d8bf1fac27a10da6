"""Registered queries of rollup maintenance, mergeable summaries, smoothing and seasonal extremes."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import readings as RD
from .functions.numeric import rnd
from .operators import cells as CE, grains, sketches as SK
from .operators.extremes import seasonal_extremes
from .operators.smoothing import smoothing_forecast
from .plans.dashboard import month_from_index
from .session import shared_dir
from .sources.standin import standin_readings
from .streaming import merge_version
from .testdata import ROLLUP_COLUMNS, curated_table, daily_table


def q_rollup_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly rollup out of cells that follow a table through three versions, corrections of stored keys among them."""
    root, cells = shared_dir(spark, "maintained-table"), shared_dir(spark, "maintained-cells")
    raw = standin_readings(spark, sf_dir)
    part = F.pmod(F.hash("meter_id", "reading_ts", "energy_kwh"), F.lit(8))   # copies of a key fall into different parts
    for own in (part < 6, part == 6, part == 7):
        merge_version(spark, raw.filter(own), root)
        CE.refresh_cells(spark, root, cells)
    return CE.hourly_from_cells(CE.read_cells(spark, cells)).select(*ROLLUP_COLUMNS)


def _sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "status-sketches")
    SK.status_sketches(curated_table(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def q_status_meters_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters by status and year from the stored hourly sketches."""
    return SK.meters_by_status(_sketches(spark, sf_dir), F.year("hour_ts").alias("year"))


def q_kpi_meters_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters in all and by status over three years, from the stored hourly sketches."""
    return SK.kpi_meters(SK.of_period(_sketches(spark, sf_dir), "1993-01-01", "1996-01-01"))


def q_histogram_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles and two tails of every column by year, from the stored daily histograms."""
    path = shared_dir(spark, "value-histograms")
    SK.value_histograms(curated_table(spark, sf_dir)).write.parquet(path)
    counts = SK.merged_histograms(spark.read.parquet(path), F.year("reading_date").alias("year"))
    return SK.histogram_quantiles(counts, (0.05, 0.25, 0.5, 0.75, 0.99), ("year",))


def q_smoothing_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-meter monthly kWh, three months ahead, by exponential smoothing."""
    m = grains.monthly(daily_table(spark, sf_dir)).withColumn("x", F.col("year") * 12 + F.col("month") - 1)
    fc = smoothing_forecast(m, ["meter_id"], "x", "kwh", 3, 0.90)
    return fc.select("meter_id", month_from_index("x_future").alias("period"), "step", rnd("forecast", 2).alias("forecast_kwh"),
                     rnd("lower", 2).alias("lower_kwh"), rnd("upper", 2).alias("upper_kwh"), "alpha", "beta")


def q_seasonal_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a town used far more or less than on its other days of that name."""
    series = daily_table(spark, sf_dir).groupBy(RD.town().alias("town"), F.col("reading_date").alias("d")).agg(F.sum("energy_kwh").alias("kwh"))
    out = seasonal_extremes(series, ["town"], "d", "kwh")
    return out.select("town", "d", rnd("kwh", 4).alias("kwh"), rnd("expected", 4).alias("expected_kwh"), rnd("deviate", 3).alias("deviate"))


def registered() -> dict:
    return {"rollup_maintenance": q_rollup_maintenance, "status_meters_sketch": q_status_meters_sketch,
            "kpi_meters_sketch": q_kpi_meters_sketch, "histogram_quantiles": q_histogram_quantiles,
            "smoothing_forecast": q_smoothing_forecast, "seasonal_extremes": q_seasonal_extremes}
