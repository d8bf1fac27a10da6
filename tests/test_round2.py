"""Faults that the stand-in data can not show: long ids, float noise, guarded divisions, overwrites, table registration."""
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from meterlake.operators.anomaly import anomaly_series
from meterlake.operators.quality import exact_quantiles, quality_report, quantile_value, rejects
from meterlake.operators.regression import forecast_grouped
from meterlake.plans import insights, predict
from meterlake.session import ensure_checkpoint_dir, get_session
from meterlake.sources.curated import register_table, write_curated, write_table
from meterlake.sources.standin import _meter_id, standin_readings
from meterlake.testdata import curated_standin
from tests.conftest import SF_SMALL


def test_long_meter_numbers_keep_their_digits(spark):
    numbers = [1, 999, 1000, 9999, 10_000, 100_000, 1_000_001]
    ids = [r[0] for r in spark.createDataFrame([(n,) for n in numbers], "n long").select(_meter_id(F.col("n"))).collect()]
    assert ids == ["MH0001", "MH0999", "BR1000", "MH9999", "BR10000", "BR100000", "MH1000001"]


def test_long_meter_numbers_in_the_stand_in_and_its_oracle(spark, tmp_dir):
    from oracle.base import with_raw
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_suppkey IN (1, 2, 3)")
    li.withColumn("l_suppkey", F.expr("CASE l_suppkey WHEN 1 THEN 1000 WHEN 2 THEN 10000 ELSE 100000 END").cast("long")) \
        .coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = {r[0] for r in standin_readings(spark, tmp_dir).select("meter_id").distinct().collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_dir}/lineitem.parquet/*.parquet')")
    assert got == {r[0] for r in con.sql(with_raw("SELECT DISTINCT meter_id FROM raw")).fetchall()} == {"BR1000", "BR10000", "BR100000"}


def _constant_meter(spark, kwh, partitions):
    start = dt.datetime(2020, 1, 1)
    rows = [("BR01", start + dt.timedelta(minutes=3 * i), kwh) for i in range(480 * 60)]
    return (spark.createDataFrame(rows, "meter_id string, reading_ts timestamp_ntz, energy_kwh double")
            .withColumn("avg_voltage", F.lit(230.0)).withColumn("avg_current", F.lit(1.0)).withColumn("frequency_hz", F.lit(50.0))
            .repartition(partitions))


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_float_noise_is_no_anomaly(spark, partitions):
    from meterlake.operators.clean import curate
    assert insights.a1_anomaly_days(curate(_constant_meter(spark, 0.007, partitions))).count() == 0


def test_a_real_spike_of_a_constant_series_is_found(spark):
    days = [("m", dt.date(2020, 1, 1) + dt.timedelta(days=i), 3.36 + (0.001 if i % 2 else 0.0) + (5 if i == 40 else 0)) for i in range(50)]
    found = anomaly_series(spark.createDataFrame(days, "k string, d date, kwh double"), ["k"], "d", "kwh").collect()
    assert [r.d for r in found] == [dt.date(2020, 2, 10)]


def test_a_series_without_a_line_does_not_abort_the_others(spark):
    rows = [("a", 1, 2.0), ("a", 1, 3.0), ("a", 1, 4.0)] + [("b", i, 2.0 * i) for i in range(5)]
    got = forecast_grouped(spark.createDataFrame(rows, "k string, x long, y double"), ["k"], "x", "y", 1).collect()
    by_key = {r.k: r for r in got}
    assert by_key["a"].forecast is None and by_key["a"].lower is None and by_key["b"].forecast == pytest.approx(10.0)


def test_idle_fleets_have_no_index_and_no_peaks(spark):
    from meterlake.operators.clean import curate
    idle = curate(_constant_meter(spark, 0.0, 2)).withColumn("power_kw", F.lit(0.0))
    assert [r.seasonal_index for r in predict.p4_seasonal_index(idle).collect()] == [None, None]
    assert [r.pct_of_peak_load for r in insights.a6_peak_contributors(idle).collect()] == [None]


def test_decimal_readings_equal_duckdb(spark, tmp_dir):
    """kWh in steps of 0.001, which are not exact in double."""
    start = dt.datetime(2020, 1, 1)
    rows = [(f"BR{m:02d}", start + dt.timedelta(hours=h), ((h * 7 + m * 13) % 50) / 1000, 221.3 + (h % 17) / 10, 0.3 * (h % 5), 49.97)
            for m in range(5) for h in range(24 * 70)]
    raw = spark.createDataFrame(rows, "meter_id string, reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double")
    from meterlake.operators.clean import curate
    from meterlake.plans import consumption
    from oracle import registered_sql
    cur = curate(raw.repartition(5))
    con = duckdb.connect()
    con.register("given", raw.toArrow())
    for name, query in {"q01_daily_kwh": consumption.q01_daily_kwh, "q02_fleet_daily_avg": consumption.q02_fleet_daily_avg,
                        "q03_monthly_kwh": consumption.q03_monthly_kwh, "p1_next_day": predict.p1_next_day,
                        "a1_anomaly_days": insights.a1_anomaly_days, "p4_seasonal_index": predict.p4_seasonal_index}.items():
        sql = registered_sql()[name]
        sql = sql.replace(sql[sql.index("li AS ("):sql.index("valid AS (")], "raw AS (SELECT * FROM given),\n")
        rel = con.sql(sql)
        df = query(cur)
        columns = sorted(rel.columns)
        want = sorted(tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall())
        assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want, name


def test_full_overwrite_drops_old_months(spark, tmp_dir):
    cur = curated_standin(spark, SF_SMALL)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for write in (write_curated, lambda df, path: write_table(df, path, partition_by=("year", "month"))):
            path = f"{tmp_dir}/t-{id(write)}"
            write(cur, path)
            write(cur.filter("year = 1996 AND month = 2"), path)
            assert [tuple(r) for r in spark.read.parquet(path).select("year", "month").distinct().collect()] == [(1996, 2)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_session_keeps_the_overwrite_default():
    from meterlake.session import DEFAULT_CONF
    assert "spark.sql.sources.partitionOverwriteMode" not in DEFAULT_CONF and get_session


def test_registering_never_drops(spark, tmp_dir):
    cur = curated_standin(spark, SF_SMALL).filter("year = 1996")
    write_curated(cur, f"{tmp_dir}/a")
    write_curated(cur, f"{tmp_dir}/b")
    name = f"kept_{tmp_dir[-6:].lower().replace('-', '_')}"
    assert register_table(spark, name, f"{tmp_dir}/a").count() == register_table(spark, name, f"{tmp_dir}/a").count() == cur.count()
    with pytest.raises(ValueError, match="exists at"):
        register_table(spark, name, f"{tmp_dir}/b")


def test_quantiles_split_by_value(spark):
    values = [((i * 7919) % 10_007) / 10 for i in range(20_000)] + [5.0] * 10_000
    df = spark.createDataFrame([(v, v / 3) for v in values], "a double, b double")
    want = sorted(values)
    for p in (0.01, 0.25, 0.5, 0.99, 1.0):
        assert quantile_value(df, "a", p) == want[max(1, -(-int(p * 100) * len(want) // 100)) - 1]
    row = {r["column"]: r for r in exact_quantiles(df, ("a", "b")).collect()}
    assert row["a"].p50 == want[len(want) // 2 - 1] and row["b"].p50 == want[len(want) // 2 - 1] / 3
    assert quantile_value(df.limit(0), "a", 0.5) is None


def test_filters_reach_the_scan(spark, tmp_dir):
    from meterlake.plans.dashboard import dashboard_filter, town_view
    from meterlake.plans.jobs import rollup_job
    rollup_job(spark, curated_standin(spark, SF_SMALL), f"{tmp_dir}/roll")
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    text = plan(dashboard_filter(spark.read.parquet(f"{tmp_dir}/roll"), since="1996-01-01", until="1997-01-01", towns=["BR"]))
    assert "PartitionFilters: [" in text and "(((year" in text and "StringStartsWith(meter_id,BR)" in text
    assert "StringStartsWith(meter_id,MH)" in plan(town_view(spark.read.parquet(f"{tmp_dir}/roll"), ["MH"], "v"))


RAW = "reading_ts string, energy_kwh string, avg_voltage string, avg_current string, frequency_hz string, meter_id string"
T0 = "2020-01-01 00:00:00"


def test_copies_are_copies_of_the_text(spark):
    """Different unparseable texts are different rejects, and keep their text."""
    rows = [(T0, "abc", "230", "1", "50", "BR01"), (T0, "xyz", "230", "1", "50", "BR01"), (T0, "xyz", "230", "1", "50", "BR01"),
            (T0, "0.1", "230", "1", "50", "BR01"), (T0, "0.10", "230", "1", "50", "BR01"), (T0, "0.05", "230", "1", "50", "BR01"),
            (T0, "0.2", "999", "1", "50", "BR02"), (T0, "0.2", "230", "1", "50", "BR03"), (T0, "0.2", "230", "1", "50", "BR03")]
    raw = spark.createDataFrame(rows, RAW).withColumn("src", F.lit("f"))
    r = quality_report(raw, "src").first()
    assert (r.rows_in, r.dupes, r.nulls, r.out_of_range, r.rows_out, r.meters) == (9, 4, 2, 1, 2, 2)
    got = sorted((x.energy_kwh, x.avg_voltage, x.reject_reason, x.copies) for x in rejects(raw.drop("src")).collect())
    assert got == [("0.1", "230", "duplicate", 1), ("0.10", "230", "duplicate", 1), ("0.2", "230", "duplicate", 1),
                   ("0.2", "999", "out_of_range", 1), ("abc", "230", "null", 1), ("xyz", "230", "null", 2)]


def test_quality_reads_the_rows_once(spark, tmp_dir):
    standin_readings(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")

    def scans(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        return final.count("FileScan parquet"), final
    n, plan = scans(quality_report(raw.withColumn("s", F.substring("meter_id", 1, 2)), "s"))
    assert n == 1 and "Join" not in plan
    assert quality_report(raw.limit(0).withColumn("s", F.lit("x")), "s").count() == 0


def test_curation_job_writes_the_rejects(spark, tmp_dir):
    from meterlake.plans.jobs import curation_job
    from meterlake.sources.standin import standin_raw_frame
    standin_raw_frame(spark, SF_SMALL).write.option("header", True).csv(f"{tmp_dir}/raw")
    m = {}
    curation_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cur", metrics=m, rejects_path=f"{tmp_dir}/rejects")
    assert spark.read.parquet(f"{tmp_dir}/rejects").agg(F.sum("copies")).first()[0] == m["rejected"]


def test_rollups_are_refreshed_by_touched_month(spark, tmp_dir):
    import os
    from meterlake.plans.jobs import daily_rollup_job, refresh_rollups, rollup_job
    cur = curated_standin(spark, SF_SMALL).filter("year = 1996")
    paths = [f"{tmp_dir}/{n}" for n in ("cur", "hourly", "daily")]
    write_curated(cur, paths[0])
    rollup_job(spark, paths[0], paths[1])
    daily_rollup_job(spark, paths[1], paths[2])
    files = lambda p, m: sorted(f for f in os.listdir(f"{p}/year=1996/month={m}") if f.endswith(".parquet"))
    before = {(p, m): files(p, m) for p in paths[1:] for m in (2, 3)}
    write_curated(cur.filter("month = 3").withColumn("energy_kwh", F.col("energy_kwh") * 2), paths[0], dynamic=True)
    refresh_rollups(spark, *paths, months=[199603])
    for p in paths[1:]:
        assert files(p, 2) == before[p, 2] and files(p, 3) != before[p, 3]
    sums = [{r[0]: r[1] for r in spark.read.parquet(p).groupBy("month").agg(F.sum("energy_kwh")).collect()} for p in paths]
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) == 12


def test_calendar_frames_skip_no_days(spark):
    from meterlake.plans import consumption
    rows = [("BR01", dt.date(2020, 1, 1), 1.0), ("BR01", dt.date(2020, 1, 7), 3.0), ("BR01", dt.date(2020, 1, 9), 5.0), ("BR01", dt.date(2020, 3, 1), 8.0)]
    daily = (spark.createDataFrame(rows, "meter_id string, reading_date date, energy_kwh double")
             .withColumn("year", F.year("reading_date")).withColumn("month", F.month("reading_date")).withColumn("readings", F.lit(1)))
    assert [r.kwh_7day_ma for r in consumption.q16_trend_7d_ma(daily, calendar=True).collect()] == [1.0, 2.0, 4.0, 8.0]
    assert [r.kwh_7day_ma for r in consumption.q16_trend_7d_ma(daily).collect()] == [1.0, 2.0, 3.0, 4.25]
    assert [r.mom_growth_pct for r in consumption.q23_mom_growth(daily, calendar=True).collect()] == [None, None]
    assert [r.mom_growth_pct for r in consumption.q23_mom_growth(daily).collect()] == [None, -11.1]
