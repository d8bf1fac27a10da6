"""Reference default thresholds on a dense frame (480 readings per meter-day)."""
from pyspark.sql import functions as F

from meterlake.operators.clean import curate
from meterlake.plans import consumption as C, health as H, insights as A, predict as PR
from meterlake.plans.insights import outage_spells


def dense(spark):
    """Meter BR01: day 1 energised but idle all day; day 2 normal with a 12-reading outage at 10:00.
    Meter MH02: day 1 complete and normal; day 2 only the first 400 readings."""
    idx = spark.range(0, 960).withColumn("i", F.col("id").cast("int"))
    ts = F.timestamp_add("MINUTE", F.col("i") * 3, F.lit("2020-06-01 00:00:00").cast("timestamp_ntz"))
    day2 = F.col("i") >= 480
    slot = F.col("i") % 480
    outage = day2 & slot.between(200, 211)
    br = idx.select(ts.alias("reading_ts"),
                    F.when(day2 & ~outage, F.lit(0.01)).otherwise(F.lit(0.0)).alias("energy_kwh"),
                    F.when(outage, F.lit(0.0)).otherwise(F.lit(230.0)).alias("avg_voltage"),
                    F.when(day2 & ~outage, F.lit(2.0)).otherwise(F.lit(0.0)).alias("avg_current"),
                    F.when(outage, F.lit(0.0)).otherwise(F.lit(50.0)).alias("frequency_hz"),
                    F.lit("BR01").alias("meter_id"))
    mh = (idx.filter(~day2 | (slot < 400))
             .select(ts.alias("reading_ts"), F.lit(0.02).alias("energy_kwh"), F.lit(228.0).alias("avg_voltage"),
                     F.lit(3.0).alias("avg_current"), F.lit(50.0).alias("frequency_hz"), F.lit("MH02").alias("meter_id")))
    return curate(br.unionByName(mh))


def test_dead_meter_default_threshold(spark):
    rows = H.q19_dead_meters(dense(spark)).collect()
    assert [(r.meter_id, str(r.reading_date), r.zero_readings) for r in rows] == [("BR01", "2020-06-01", 480)]


def test_outage_default_threshold_and_spell(spark):
    rows = A.a3_outage_hours(dense(spark)).collect()
    assert [(r.meter_id, r.outage_intervals, r.est_outage_hours) for r in rows] == [("BR01", 12, 0.6)]
    sp = outage_spells(dense(spark)).collect()
    assert len(sp) == 1 and sp[0].readings == 12 and str(sp[0].spell_start) == "2020-06-02 10:00:00"


def test_completeness_flags_short_day_only(spark):
    rows = C.q28_completeness(dense(spark)).collect()
    assert [(r.meter_id, str(r.reading_date), r.readings, r.completeness_pct) for r in rows] == \
        [("MH02", "2020-06-02", 400, 83.3)]


def test_load_profile_scales_to_hour(spark):
    r = PR.p3_load_profile(dense(spark)).filter("meter_id = 'MH02' AND hour = 0").collect()[0]
    assert r.avg_hourly_kwh == 0.4


def test_segments_use_480_per_day(spark):
    seg = {r.meter_id: (r.avg_daily_kwh, r.usage_segment) for r in A.a4_segments(dense(spark)).collect()}
    assert seg["MH02"] == (9.6, "HIGH")


def test_next_month_wraps_the_year(spark):
    rows = []
    for m in (10, 11, 12):
        rows.append((f"2020-{m:02d}-15 00:03:00", 0.01 * m, 230.0, 1.0, 50.0, "BR01"))
    df = spark.createDataFrame(rows, "reading_ts string, energy_kwh double, avg_voltage double, "
                                     "avg_current double, frequency_hz double, meter_id string")
    r = PR.p2_next_month(curate(df)).collect()[0]
    assert (r.months_observed, r.pred_year, r.pred_month, r.predicted_kwh) == (3, 2021, 1, 0.13)


def test_load_factor_null_sorts_last(spark):
    from meterlake.plans.power_quality import q26_load_factor
    rows = [("2020-01-01 00:03:00", 0.01, 230.0, 0.0, 50.0, "BR01"),     # no demand at all → NULL
            ("2020-01-01 00:03:00", 0.01, 230.0, 2.0, 50.0, "MH02"),
            ("2020-01-01 00:06:00", 0.01, 230.0, 4.0, 50.0, "MH02")]
    df = spark.createDataFrame(rows, "reading_ts string, energy_kwh double, avg_voltage double, "
                                     "avg_current double, frequency_hz double, meter_id string")
    got = [(r.meter_id, r.load_factor) for r in q26_load_factor(curate(df)).collect()]
    assert got == [("MH02", 0.75), ("BR01", None)]


def test_anomaly_needs_history(spark):
    from meterlake.plans.insights import a1_anomaly_days
    rows = [(f"2020-01-{d:02d} 00:03:00", 0.01 + 0.001 * (d % 2), 230.0, 1.0, 50.0, "BR01") for d in range(1, 11)]
    rows.append(("2020-01-11 00:03:00", 5.0, 230.0, 1.0, 50.0, "BR01"))
    df = curate(spark.createDataFrame(rows, "reading_ts string, energy_kwh double, avg_voltage double, "
                                            "avg_current double, frequency_hz double, meter_id string"))
    got = a1_anomaly_days(df).collect()
    assert [(str(r.d), r.anomaly_type) for r in got] == [("2020-01-11", "SPIKE")]
    assert a1_anomaly_days(df, min_history=11).count() == 0
