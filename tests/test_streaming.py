"""Streaming: availableNow over split files equals batch; a replayed run is a no-op; late corrections merge."""
import os

import pytest
from pyspark.sql import functions as F

from meterlake.rules import CURATED_COLUMNS
from meterlake.sources.standin import as_raw_frame, events_readings, standin_raw_frame, standin_readings
from meterlake.streaming import accounting, alert_windows, dead_letters, health_alerts_stream, incremental_ingest, outage_spells_stream
from meterlake.testdata import curated_standin
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_in_parts_equals_batch_and_replay_is_noop(spark, tmp_dir):
    raw = standin_raw_frame(spark, SF_SMALL).withColumn("_p", F.abs(F.hash("meter")) % 3)
    for p in range(3):   # three landings, written one after the other
        raw.filter(F.col("_p") == p).drop("_p").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/p{p}")
    table, ck = f"{tmp_dir}/table", f"{tmp_dir}/ck"
    first = incremental_ingest(spark, f"{tmp_dir}/land", table, ck, max_files_per_trigger=1)
    assert first["batches"] == 3
    expected = curated_standin(spark, SF_SMALL).select(*CURATED_COLUMNS)
    assert _same(spark.read.parquet(table).select(*CURATED_COLUMNS), expected)
    again = incremental_ingest(spark, f"{tmp_dir}/land", table, ck, max_files_per_trigger=1)
    assert again["batches"] == 0
    assert _same(spark.read.parquet(table).select(*CURATED_COLUMNS), expected)


def test_late_correction_replaces_key(spark, tmp_dir):
    readings = standin_readings(spark, SF_SMALL)
    as_raw_frame(readings).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/a")
    table, ck = f"{tmp_dir}/table", f"{tmp_dir}/ck"
    incremental_ingest(spark, f"{tmp_dir}/land", table, ck)
    key = spark.read.parquet(table).filter(F.col("energy_kwh") > 0).orderBy("meter_id", "reading_ts").first()
    fix = spark.createDataFrame([(key.reading_ts, 0.0, 230.0, 1.5, 50.0, key.meter_id)],
                                "reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, "
                                "frequency_hz double, meter_id string")
    as_raw_frame(fix).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/b")
    out = incremental_ingest(spark, f"{tmp_dir}/land", table, ck)
    assert out["batches"] == 1
    t = spark.read.parquet(table)
    assert t.count() == curated_standin(spark, SF_SMALL).count()
    row = t.filter((F.col("meter_id") == key.meter_id) & (F.col("reading_ts") == key.reading_ts)).collect()
    assert len(row) == 1 and row[0].energy_kwh == 0.0 and row[0].health_status == "POSSIBLE_METER_ISSUE"


def test_alert_stream_in_time_order_equals_batch(spark, tmp_dir):
    ev = events_readings(spark, SF_SMALL)
    days = F.dayofmonth("reading_ts")
    for i, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):   # time-ordered landings
        as_raw_frame(ev.filter(days.between(lo, hi))).coalesce(1).write.option("header", True) \
            .csv(f"{tmp_dir}/land/part{i}")
    health_alerts_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck", max_files_per_trigger=1)
    got = spark.read.parquet(f"{tmp_dir}/sink")
    batch = alert_windows(ev)
    last = ev.agg(F.max("reading_ts")).collect()[0][0]
    import datetime as dt
    closed = batch.filter(F.col("window_end") <= F.lit(last - dt.timedelta(minutes=10)))
    assert got.count() > 0
    assert _same(got, closed)


def test_replayed_batch_reapplies_staged_merge(spark, tmp_dir):
    """A batch whose staging finished is re-applied from staging, even if the stored months changed since."""
    from meterlake.streaming.ingest import merge_batch
    from meterlake.sources.raw import normalize_columns
    raw = normalize_columns(standin_raw_frame(spark, SF_SMALL))
    table, staging = f"{tmp_dir}/table", f"{tmp_dir}/staging"
    merge_batch(spark, raw, table, staging, batch_id=7)
    expected = curated_standin(spark, SF_SMALL).select(*CURATED_COLUMNS)
    # simulate a crash in the middle of the overwrite: one month of the table lost
    t = spark.read.parquet(table)
    one = t.select("year", "month").orderBy("year", "month").first()
    broken = t.filter(~((F.col("year") == one.year) & (F.col("month") == one.month)))
    broken.write.mode("overwrite").parquet(f"{tmp_dir}/broken")
    spark.read.parquet(f"{tmp_dir}/broken").write.mode("overwrite").partitionBy("year", "month").parquet(table)
    merge_batch(spark, raw, table, staging, batch_id=7)   # replay of the same batch id
    assert _same(spark.read.parquet(table).select(*CURATED_COLUMNS), expected)


def test_alert_stream_drops_rows_behind_the_watermark(spark, tmp_dir):
    """A file landed after the watermark passed its readings contributes nothing (late data is dropped)."""
    ev = events_readings(spark, SF_SMALL)
    days = F.dayofmonth("reading_ts")
    as_raw_frame(ev.filter(days >= 16)).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/a_late_half")
    sink, ck = f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    health_alerts_stream(spark, f"{tmp_dir}/land", sink, ck)
    first = spark.read.parquet(sink).count()
    assert first > 0
    # the first half of the month arrives later: every reading is older than the watermark
    as_raw_frame(ev.filter(days < 16)).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/b_early_half")
    health_alerts_stream(spark, f"{tmp_dir}/land", sink, ck)
    got = spark.read.parquet(sink)
    assert got.count() == first
    assert got.filter(F.dayofmonth("window_start") < 16).count() == 0


def test_new_keys_append_without_rewriting_months(spark, tmp_dir):
    """A batch of new keys adds files; the files already stored stay untouched."""
    readings = standin_readings(spark, SF_SMALL)
    half = F.abs(F.hash("meter_id", "reading_ts")) % 2
    as_raw_frame(readings.filter(half == 0)).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/a")
    table, ck = f"{tmp_dir}/table", f"{tmp_dir}/ck"
    incremental_ingest(spark, f"{tmp_dir}/land", table, ck)
    files_before = {r[0] for r in spark.read.parquet(table).select(F.input_file_name()).distinct().collect()}
    as_raw_frame(readings.filter(half == 1)).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/b")
    incremental_ingest(spark, f"{tmp_dir}/land", table, ck)
    files_after = {r[0] for r in spark.read.parquet(table).select(F.input_file_name()).distinct().collect()}
    expected = curated_standin(spark, SF_SMALL).select(*CURATED_COLUMNS)
    got = spark.read.parquet(table).select(*CURATED_COLUMNS)
    assert _same(got, expected)
    # the second batch may rewrite the few months where one of its copies beats a stored copy of a key
    assert len(files_before & files_after) >= len(files_before) // 2


HEADER = "x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter"


def _landed(folder, name, header, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_ingest_maps_headers_counts_all_batches_and_drops_staging(spark, tmp_dir):
    land, table, ck = f"{tmp_dir}/Aggregated_zone/in", f"{tmp_dir}/table", f"{tmp_dir}/ck"
    for i in range(4):
        _landed(land, f"f{i}.csv", HEADER, f"2020-0{i + 1}-01 00:00:00,0.01,23{i},1.5,50,BR01")
    _landed(land, "g.csv", "meter,x_timestamp,t_kwh,z_avg_current_(amp),z_avg_voltage_(volt),y_freq (hz)", "BR02,2020-01-01 00:00:00,0.02,2.5,199,49.9")
    _landed(land, "SM_Aggregated.csv", "meter,Date,t_kWh", "BR01,2020-01-01,1")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        out = incremental_ingest(spark, land, table, ck, max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (out["batches"], out["rows"], out["months"]) == (5, 5, [202001, 202002, 202003, 202004])
    odd = spark.read.parquet(table).filter("meter_id = 'BR02'").first()
    assert (odd.avg_voltage, odd.avg_current, odd.energy_kwh) == (199.0, 2.5, 0.02)
    assert not os.listdir(f"{ck}/staging")


def test_an_unreadable_table_is_not_an_empty_one(spark, tmp_dir):
    _landed(f"{tmp_dir}/land", "a.csv", HEADER, "2020-01-01 00:00:00,0.01,230,1.5,50,BR01")
    os.makedirs(f"{tmp_dir}/table/year=2020/month=1")
    with open(f"{tmp_dir}/table/year=2020/month=1/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        incremental_ingest(spark, f"{tmp_dir}/land", f"{tmp_dir}/table", f"{tmp_dir}/ck")
    assert open(f"{tmp_dir}/table/year=2020/month=1/part-0.parquet").read() == "not parquet"


TURNED = "meter,x_timestamp,t_kwh,z_avg_current_(amp),z_avg_voltage_(volt),y_freq (hz)"


def test_alert_stream_takes_each_file_by_its_header(spark, tmp_dir):
    _landed(f"{tmp_dir}/land", "a.csv", HEADER, "2020-01-01 00:00:00,0.01,250,1.5,50,BR01", "2020-01-02 00:00:00,0.01,230,1.5,50,BR09")
    _landed(f"{tmp_dir}/land", "b.csv", TURNED, "BR02,2020-01-01 00:03:00,0.02,2.5,199,49.9")
    out = health_alerts_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck")
    got = {(r.meter_id, r.critical, r.warning) for r in spark.read.parquet(f"{tmp_dir}/sink").collect()}
    assert got == {("BR01", 1, 0), ("BR02", 0, 1)}
    assert accounting(spark, out["staged"]) == {"landed": 3, "staged": 3, "null": 0, "out_of_range": 0, "late": 0}


def test_alert_stream_stops_at_a_file_without_a_header(spark, tmp_dir):
    _landed(f"{tmp_dir}/land", "a.csv", "2020-01-01 00:00:00,0.01,230,1.5,50,BR01")
    with pytest.raises(Exception, match="a.csv has no header line"):
        health_alerts_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck")


def test_every_landed_row_is_counted_a_copy_rejected_or_late(spark, tmp_dir):
    """Rows landed = counted in windows + copies + rejected + late, over several runs."""
    land, sink, ck = f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    row = "2020-01-01 {},0.01,250,1.5,50,BR01".format
    _landed(land, "a.csv", HEADER, row("10:00:00"), row("10:03:00"), row("10:03:00"), row("10:06:00").replace("250", "450"),
            row("10:09:00").replace("0.01", "x"), "garbage")
    run = lambda: health_alerts_stream(spark, land, sink, ck, min_unhealthy=0)
    out = run()
    # 10:00 is behind 10:03 less ten minutes by none; 09:53 is exactly at the watermark, and late
    _landed(land, "b.csv", HEADER, row("09:53:00"), row("09:54:00"), row("09:30:00"), row("10:20:00"))
    run()
    _landed(land, "c.csv", TURNED, "BR02,2020-01-02 00:00:00,0.02,2.5,199,49.9")
    run()
    assert accounting(spark, out["staged"]) == {"landed": 11, "staged": 6, "null": 2, "out_of_range": 1, "late": 2}
    dead = {(r.line, os.path.basename(r.file), r.reason) for r in dead_letters(spark, out["staged"]).collect()}
    assert dead == {(row("10:06:00").replace("250", "450"), "a.csv", "out_of_range"), (row("10:09:00").replace("0.01", "x"), "a.csv", "null"),
                    ("garbage", "a.csv", "null"), (row("09:53:00"), "b.csv", "late"), (row("09:30:00"), "b.csv", "late")}
    got = {(str(r.window_start), r.readings) for r in spark.read.parquet(sink).collect()}
    # the windows of BR01 are closed, the one of BR02 is open
    assert got == {("2020-01-01 09:45:00", 1), ("2020-01-01 10:00:00", 2), ("2020-01-01 10:15:00", 1)}
    # 11 landed = 4 counted + 1 in the open window + 1 copy + 3 rejected + 2 late
    assert run()["rows"] == 0


def _times(*minutes):
    import datetime as dt
    return [dt.datetime(2020, 1, 1) + dt.timedelta(minutes=m) for m in minutes]


def test_spell_stream_equals_batch_spells(spark, tmp_dir):
    from meterlake.operators.clean import curate
    from meterlake.operators.spells import outage_spells
    readings = spark.createDataFrame(
        [(t, 0.0, 0.0, 0.0, 0.0, "BR01") for t in _times(0, 3, 6, 12, 15, 60, 62.5, 65.5, 70)]
        # a copy with voltage loses against the zero one, which is lower; a lower zero-energy copy with voltage wins
        + [(t, 0.5, 230.0, 1.5, 50.0, "BR01") for t in _times(3)] + [(t, 0.25, 0.0, 0.0, 0.0, "BR02") for t in _times(0, 3, 6)]
        + [(t, 0.0, 230.0, 1.5, 50.0, "BR02") for t in _times(3)] + [(t, 0.5, 230.0, 1.5, 50.0, "BR03") for t in _times(24 * 60)]
        + [(t, 0.0, 0.0, 0.0, 0.0, "MH01") for t in _times(*range(23 * 60, 25 * 60, 3))],
        "reading_ts timestamp_ntz, energy_kwh double, avg_voltage double, avg_current double, frequency_hz double, meter_id string")
    for i in range(5):   # five landings; spells go on from one to the next
        part = readings.filter(F.floor(F.hour("reading_ts") * 60 + F.minute("reading_ts")) % 5 == i) if i else readings.filter("minute(reading_ts) % 5 = 0")
        as_raw_frame(part).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/land/p{i}")
    sink, ck = f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    outage_spells_stream(spark, f"{tmp_dir}/land", sink, ck)
    # a later reading closes all but the spells of the last minutes
    _landed(f"{tmp_dir}/land", "z.csv", HEADER, "2020-01-03 00:00:00,0.01,230,1.5,50,BR01")
    outage_spells_stream(spark, f"{tmp_dir}/land", sink, ck)
    batch = outage_spells(curate(spark.createDataFrame(readings.rdd, readings.schema)))
    got = spark.read.parquet(sink)
    assert batch.count() >= 6 and _same(got.select(*batch.columns), batch)


@pytest.mark.parametrize("seconds,spells", [(180, 1), (181, 2), (182, 2)])
def test_spell_gap_is_one_interval(spark, tmp_dir, seconds, spells):
    rows = [f"2020-01-01 00:00:00,0,0,0,0,BR01", f"2020-01-01 00:{seconds // 60:02d}:{seconds % 60:02d},0,0,0,0,BR01", "2020-01-02 00:00:00,0,230,0,0,BR01"]
    _landed(f"{tmp_dir}/land", "a.csv", HEADER, *rows)
    outage_spells_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/sink", f"{tmp_dir}/ck")
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == spells
