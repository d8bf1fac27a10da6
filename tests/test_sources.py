"""Raw CSV reading, curated table write/read with partition pruning, catalog registration."""
import os

import pytest
from pyspark.sql import functions as F

from meterlake.plans.jobs import curation_job, rollup_job
from meterlake.sources.curated import read_curated, register_table, write_curated
from meterlake.sources.raw import normalize_columns, read_raw_csv
from meterlake.sources.standin import standin_raw_frame
from meterlake.testdata import curated_standin
from tests.conftest import SF_SMALL


def test_aggregated_files_are_skipped(spark, tmp_dir):
    standin_raw_frame(spark, SF_SMALL).write.option("header", True).csv(f"{tmp_dir}/land/Aggregated_zone/in")
    with open(f"{tmp_dir}/land/SM_Aggregated_2020.csv", "w") as f:
        f.write("meter,Date,t_kWh\nBR01,2020-01-01,1.5\n")
    df = normalize_columns(read_raw_csv(spark, f"{tmp_dir}/land", keep_file=True))
    assert df.count() == standin_raw_frame(spark, SF_SMALL).count()
    assert df.filter(F.col("source_file").contains("Aggregated")).count() == 0


def _land(folder, name, header, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_each_file_by_its_own_header(spark, tmp_dir):
    _land(f"{tmp_dir}/a", "one.csv", "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter",
          "2020-01-01 00:00:00,0.01,231,1.5,50,BR01", "2020-01-01 00:03:00,0.02,232,1.6,50,BR01")
    _land(f"{tmp_dir}/a", "two.csv", " METER,Y_Freq_(Hz),z_avg_current (amp),Z_AVG_VOLTAGE_(VOLT),t_kwh ,X_TIMESTAMP,more",
          "BR02,49,1.5,201,0.03,2020-01-01 00:00:00,x")
    _land(f"{tmp_dir}/b", "three.csv", "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter",
          '2020-01-01 00:06:00,0.04,"233",1.7,50,BR01')
    df = normalize_columns(read_raw_csv(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"], keep_file=True))
    want = [("2020-01-01 00:00:00", "0.01", "231", "1.5", "50", "BR01", "one.csv"), ("2020-01-01 00:00:00", "0.03", "201", "1.5", "49", "BR02", "two.csv"),
            ("2020-01-01 00:03:00", "0.02", "232", "1.6", "50", "BR01", "one.csv"), ("2020-01-01 00:06:00", "0.04", "233", "1.7", "50", "BR01", "three.csv")]
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_files_without_a_column_or_a_header_are_errors(spark, tmp_dir):
    _land(f"{tmp_dir}/a", "one.csv", "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter", "2020-01-01 00:00:00,0.01,231,1.5,50,BR01")
    _land(f"{tmp_dir}/a", "two.csv", "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz)", "2020-01-01 00:00:00,0.01,231,1.5,50")
    with pytest.raises(ValueError, match="two.csv.*meter|meter.*two.csv"):
        read_raw_csv(spark, f"{tmp_dir}/a")
    _land(f"{tmp_dir}/b", "one.csv", "2020-01-01 00:00:00,0.01,231,1.5,50,BR01", "2020-01-01 00:03:00,0.01,231,1.5,50,BR01")
    with pytest.raises(ValueError, match="no header"):
        read_raw_csv(spark, f"{tmp_dir}/b")
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, f"{tmp_dir}/b", pattern="*.txt")


def test_curation_job_and_partition_pruning(spark, tmp_dir):
    standin_raw_frame(spark, SF_SMALL).write.option("header", True).csv(f"{tmp_dir}/raw")
    m = {}
    n = curation_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cur", metrics=m)
    assert n == curated_standin(spark, SF_SMALL).count()
    raw_rows = standin_raw_frame(spark, SF_SMALL).count()
    assert m == {"rows_in": raw_rows, "rows_out": n, "rejected": raw_rows - n}
    df = read_curated(spark, f"{tmp_dir}/cur", since="1998-02-10", until="1998-05-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(((year" in plan
    assert "PushedFilters: [IsNotNull(reading_ts)" in plan
    got = df.agg(F.min("reading_ts"), F.max("reading_ts")).collect()[0]
    assert str(got[0]) >= "1998-02-10" and str(got[1]) < "1998-05-01"
    assert df.count() == curated_standin(spark, SF_SMALL).filter(
        (F.col("reading_ts") >= "1998-02-10") & (F.col("reading_ts") < "1998-05-01")).count()
    rollup_job(spark, f"{tmp_dir}/cur", f"{tmp_dir}/roll")
    assert spark.read.parquet(f"{tmp_dir}/roll").agg(F.sum("readings")).collect()[0][0] == n


def test_register_table_discovers_partitions(spark, tmp_dir):
    write_curated(curated_standin(spark, SF_SMALL), f"{tmp_dir}/cur")
    t = register_table(spark, "test_meter_readings", f"{tmp_dir}/cur")
    assert t.count() == curated_standin(spark, SF_SMALL).count()
    assert spark.sql("SHOW PARTITIONS test_meter_readings").count() == t.select("year", "month").distinct().count()


def test_incremental_write_replaces_only_touched_months(spark, tmp_dir):
    cur = curated_standin(spark, SF_SMALL)
    write_curated(cur, f"{tmp_dir}/cur")
    one_month = cur.filter((F.col("year") == 1996) & (F.col("month") == 3)).limit(3)
    write_curated(one_month, f"{tmp_dir}/cur", dynamic=True)
    after = spark.read.parquet(f"{tmp_dir}/cur")
    assert after.filter((F.col("year") == 1996) & (F.col("month") == 3)).count() == 3
    assert after.filter(~((F.col("year") == 1996) & (F.col("month") == 3))).count() == \
        cur.filter(~((F.col("year") == 1996) & (F.col("month") == 3))).count()


def test_quality_report_per_file(spark, tmp_dir):
    from meterlake.operators.quality import quality_report
    raw = standin_raw_frame(spark, SF_SMALL)
    raw.filter(F.col("meter").startswith("BR")).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/br")
    raw.filter(F.col("meter").startswith("MH")).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/mh")
    df = normalize_columns(read_raw_csv(spark, f"{tmp_dir}/land", keep_file=True))
    rep = quality_report(df, "source_file").collect()
    assert len(rep) == 2
    assert sum(r.rows_in for r in rep) == raw.count()
    assert sum(r.rows_out for r in rep) == curated_standin(spark, SF_SMALL).count()
    for r in rep:
        assert r.rows_in == r.rows_out + r.dupes + r.nulls + r.out_of_range


def test_latest_year_prunes_partitions(spark, tmp_dir):
    from meterlake.plans.health import q08_health_summary
    write_curated(curated_standin(spark, SF_SMALL), f"{tmp_dir}/cur")
    df = q08_health_summary(spark.read.parquet(f"{tmp_dir}/cur"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= Subquery" in plan
