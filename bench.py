"""Benchmark: curation job + every reference query + dashboard feeds at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (not timed): the stand-in readings are landed as raw CSV, as the
reference's job reads them. Timed: the curation job (CSV → partitioned
Parquet), the hourly rollup job, then each query over the written tables,
forced with the ``noop`` sink so the whole result is computed and nothing is
collected. Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlake.plans import consumption as C, dashboard as D, health as H  # noqa: E402
from meterlake.plans import insights as A, power_quality as P, predict as PR  # noqa: E402
from meterlake.plans.jobs import curation_job, daily_rollup_job, rollup_job  # noqa: E402
from meterlake.session import get_session  # noqa: E402
from meterlake.sources.standin import standin_raw_frame  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
WARMUP_SF_DIR = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.01")
# also time the curation job on the stand-in landed as k× the meters (steady-state throughput); 0 = skip
SCALED = int(os.environ.get("BENCH_SCALED", "8"))
# k > 1 lands k copies of the stand-in as k times as many meters over the same months (copy j appends
# its number to every meter id, keeping the town prefix), to measure throughput at the reference's run
# size (k=36 at sf0.1 ≈ 21.7M rows). Default 1: the given scale.
SCALEUP = int(os.environ.get("BENCH_SCALEUP", "1"))
ONLY_CURATE = os.environ.get("BENCH_ONLY_CURATE", "0") == "1"


def landed_raw(spark, sf_dir: str, copies: int):
    from pyspark.sql import functions as F
    from meterlake.sources.standin import as_raw_frame, standin_readings
    base = standin_readings(spark, sf_dir)
    if copies <= 1:
        return as_raw_frame(base)
    k = spark.range(copies).select(F.lpad(F.col("id").cast("string"), len(str(copies - 1)), "0").alias("_k"))
    more_meters = base.crossJoin(F.broadcast(k)).withColumn(
        "meter_id", F.concat(F.col("meter_id"), F.col("_k"))).drop("_k")
    return as_raw_frame(more_meters)

CURATED_QUERIES = {
    "q01": C.q01_daily_kwh, "q02": C.q02_fleet_daily_avg, "q03": C.q03_monthly_kwh, "q04": C.q04_top_consumers,
    "q05": C.q05_peak_hours, "q06": P.q06_voltage_bands, "q07": P.q07_current_bands, "q08": H.q08_health_summary,
    "q09": H.q09_health_trend, "q10": C.q10_weekend_split, "q11": P.q11_hourly_power,
    "q12": P.q12_abnormal_voltage, "q13": H.q13_unhealthiest, "q14": P.q14_peak_load, "q15": P.q15_base_load,
    "q16": C.q16_trend_7d_ma, "q17": P.q17_voltage_trend, "q18": H.q18_overvoltage,
    "q19": lambda df: H.q19_dead_meters(df, min_readings=0), "q20": P.q20_freq_stability,
    "q21": C.q21_heatmap, "q22": P.q22_high_load, "q23": C.q23_mom_growth, "q24": H.q24_kpis,
    "q25": H.q25_dominant_status, "q26": P.q26_load_factor, "q27": P.q27_sag_swell, "q28": C.q28_completeness,
    "p1": PR.p1_next_day, "p2": PR.p2_next_month, "p3": PR.p3_load_profile, "p4": PR.p4_seasonal_index,
    "a1": A.a1_anomaly_days, "a2": lambda df: A.a2_theft_indicator(df, min_prev_kwh=0.005),
    "a3": lambda df: A.a3_outage_hours(df, min_readings=2), "a4": A.a4_segments, "a5": A.a5_voltage_quality,
    "a6": A.a6_peak_contributors, "d17": D.d17_voltage_band_bar, "d18": D.d18_unhealthy_table,
    "d20": D.d20_outage_by_meter,
}
ROLLUP_QUERIES = {
    "d01": D.d01_kpi_tiles, "d02": D.d02_health_gauge, "d03": D.d03_health_pie, "d04": D.d04_monthly_line,
    "d05": D.d05_monthly_forecast, "d07": D.d07_daily_line, "d08": D.d08_daily_forecast,
    "d09": D.d09_daily_anomalies, "d10": D.d10_top_consumers, "d11": D.d11_heatmap, "d12": D.d12_weekend_trend,
    "d13": D.d13_power_combo, "d14": D.d14_forecast_narrative, "d15": D.d15_voltage_trend,
    "d16": D.d16_current_trend, "d19": D.d19_health_trend,
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


#: day- and month-grain queries, which read the daily rollup
DAILY_GRAIN = ("q01", "q02", "q03", "q16", "q23", "p1", "p2", "a1", "a2")


def operator_runs(spark, raw_dir: str, curated, work: str) -> dict:
    """Curation, quality, forecast and streaming operators over the landed files and the curated table."""
    from pyspark.sql import functions as F
    from meterlake.functions.readings import reading_date, town
    from meterlake.operators import grains, quality as Q
    from meterlake.operators.anomaly import anomaly_series
    from meterlake.operators.clean import typed_readings
    from meterlake.operators.regression import forecast_grouped
    from meterlake.sources.curated import write_clean_csv
    from meterlake.sources.raw import normalize_columns, read_raw_csv
    from meterlake.sources.standin import as_raw_frame, events_readings
    from meterlake.streaming import health_alerts_stream, incremental_ingest
    given = normalize_columns(read_raw_csv(spark, raw_dir, keep_file=True))
    months = grains.monthly(curated).withColumn("x", F.col("year") * 12 + F.col("month"))
    towns = curated.groupBy(town().alias("town"), reading_date().alias("d")).agg(F.sum("energy_kwh").alias("kwh"))

    def alerts() -> None:
        as_raw_frame(events_readings(spark, SF_DIR)).write.option("header", True).csv(f"{work}/events")
        health_alerts_stream(spark, f"{work}/events", f"{work}/alerts")

    return {
        "quality_report": lambda: run(Q.quality_report(given, "source_file")),
        "rejects": lambda: run(Q.rejects(given.drop("source_file"))),
        "curated_checks": lambda: run(Q.curated_checks(given.drop("source_file"), curated)),
        "summary_stats": lambda: run(Q.summary_stats(curated)),
        "outage_spells": lambda: run(A.outage_spells(curated)),
        "forecast_grouped": lambda: run(forecast_grouped(months, ["meter_id"], "x", "kwh", 3)),
        "forecast_seasonal": lambda: run(forecast_grouped(months, ["meter_id"], "x", "kwh", 3, method="seasonal")),
        "anomaly_series": lambda: run(anomaly_series(towns, ["town"], "d", "kwh", n=None)),
        "write_clean_csv": lambda: write_clean_csv(typed_readings(given).dropna(), f"{work}/clean"),
        "incremental_ingest": lambda: incremental_ingest(spark, raw_dir, f"{work}/ingested", f"{work}/ingest-ck"),
        "health_alerts_stream": alerts,
    }


def main() -> None:
    spark = get_session(f"local[{CPUS}]", app="meterlake-bench", shuffle_partitions=2 * CPUS,
                        extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterlake-bench-ckpt-"))
    work = tempfile.mkdtemp(prefix="meterlake-bench-")
    raw_dir, cur_dir, roll_dir = f"{work}/raw", f"{work}/curated", f"{work}/rollup"

    landed_raw(spark, SF_DIR, SCALEUP).write.option("header", True).csv(raw_dir)   # setup, untimed
    rows_in = spark.read.option("header", True).csv(raw_dir).count()
    # JVM/JIT warm-up on the smallest test scale (untimed), so the timed job measures steady state
    warm = f"{work}/warm"
    standin_raw_frame(spark, WARMUP_SF_DIR).write.option("header", True).csv(f"{warm}/raw")
    curation_job(spark, f"{warm}/raw", f"{warm}/curated")
    rollup_job(spark, f"{warm}/curated", f"{warm}/rollup")

    times: dict[str, float] = {}
    t0 = time.time()
    rows_out = curation_job(spark, raw_dir, cur_dir)
    times["curate"] = time.time() - t0

    curated = spark.read.parquet(cur_dir)
    if ONLY_CURATE:
        print(json.dumps({"metric": "curate_sec", "value": round(times["curate"], 3), "unit": "sec",
                          "rows_in": rows_in, "rows_curated": rows_out, "scaleup": SCALEUP, "cpus": CPUS,
                          "curate_rows_per_sec": round(rows_in / times["curate"], 1)}))
        return
    run(H.q24_kpis(curated))   # JIT warm-up, untimed

    t0 = time.time()
    rollup_job(spark, curated, roll_dir)
    times["rollup"] = time.time() - t0
    rollup = spark.read.parquet(roll_dir)
    t0 = time.time()
    daily_rollup_job(spark, rollup, f"{work}/daily")
    times["daily_rollup"] = time.time() - t0
    by_day = spark.read.parquet(f"{work}/daily")

    errors: dict[str, str] = {}
    for group, table in ((CURATED_QUERIES, curated), (ROLLUP_QUERIES, rollup)):
        for name, fn in group.items():
            t0 = time.time()
            try:
                run(fn(by_day if name in DAILY_GRAIN else table))
                times[name] = time.time() - t0
            except Exception as e:  # noqa: BLE001 - report and keep measuring the others
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    total = sum(times.values())
    operators: dict[str, float] = {}   # beside the total, which stays comparable between rounds
    for name, fn in operator_runs(spark, raw_dir, curated, work).items():
        t0 = time.time()
        try:
            fn()
            operators[name] = time.time() - t0
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    scaled = {}
    if SCALED > 1 and not ONLY_CURATE:
        big = f"{work}/raw_x{SCALED}"
        landed_raw(spark, SF_DIR, SCALED).write.option("header", True).csv(big)   # setup, untimed
        big_in = spark.read.option("header", True).csv(big).count()
        t0 = time.time()
        curation_job(spark, big, f"{work}/curated_x{SCALED}")
        el = time.time() - t0
        scaled = {f"curate_x{SCALED}_sec": round(el, 3), f"curate_x{SCALED}_rows_in": big_in,
                  f"curate_x{SCALED}_rows_per_sec": round(big_in / el, 1)}
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS, "scaleup": SCALEUP, "rows_in": rows_in, "rows_curated": rows_out,
        "curate_rows_per_sec": round(rows_in / times["curate"], 1),
        "query_sec": round(total - times["curate"] - times["rollup"] - times["daily_rollup"], 3),
        "operators": {k: round(v, 3) for k, v in operators.items()},
        **scaled,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
